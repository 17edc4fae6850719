"""Robots policies: parsing, rule patterns and admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raqim.functions import urls
from raqim.functions.text import trim

MAX_BYTES = 512 * 1024
#: Characters that encodeURI leaves alone; everything else, the percent sign included, is escaped.
_KEPT = tuple((c, x) for c, x in urls._KEPT if x not in "%|[]^") + (("%23", "#"), ("%3F", "?"))


def normal_path(p: Column) -> Column:
    """A rule's or page's path in comparable form.  As the percent sign is escaped too, text that is encoded already comes out
    encoded twice, on both sides of the comparison."""
    out = F.replace(F.url_encode(trim(F.coalesce(p, F.lit("")))), F.lit("+"), F.lit("%20"))
    for code, char in _KEPT:
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


def rule_regex(pattern: Column) -> Column:
    """``*`` as a wildcard, a trailing ``$`` as the end, the rest literal, matched from the start."""
    anchored = F.endswith(pattern, F.lit("$"))
    body = F.when(anchored, F.substr(pattern, F.lit(1), F.length(pattern) - 1)).otherwise(pattern)
    quoted = F.regexp_replace(body, r"([|\\{}()\[\]^$+?.])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(quoted, F.lit("*"), F.lit(".*")), F.when(anchored, "$").otherwise(""))


def specificity(pattern: Column) -> Column:
    """Bytes of the pattern without wildcards and anchors."""
    return F.octet_length(F.regexp_replace(pattern, r"[*$]", ""))


def limited_body(body: Column) -> Column:
    """At most the first 512 KiB of a fetched file, as text."""
    return F.decode(F.substring(body, 1, MAX_BYTES), "UTF-8")


def parse(robots: DataFrame, key: str = "origin", text: str = "body", tokens: tuple[str, ...] = ("crawler",)) -> tuple[DataFrame, DataFrame]:
    """(rules: key, allow, pattern, in order; sitemaps: key, url) of the groups that apply to the product tokens.

    A user-agent line opens a group only if the one before it has rules already; groups that name a token or a prefix of one
    apply together, else all ``*`` groups.  Sitemap lines count wherever they stand.  An empty value makes no rule."""
    lines = robots.select(key, F.posexplode(F.split(F.regexp_replace(F.col(text), "^\\x{FEFF}", ""), r"\r?\n")).alias("at", "line"))
    lines = lines.withColumn("line", trim(F.regexp_replace("line", "#.*$", ""))).filter(F.instr("line", ":") > 0)
    lines = lines.select(key, "at", F.lower(trim(F.substring_index("line", ":", 1))).alias("name"), trim(F.expr("substr(line, instr(line, ':') + 1)")).alias("value"))
    sitemaps = lines.filter("name = 'sitemap' and value <> ''").select(key, F.col("value").alias("url")).distinct()
    own = Window.partitionBy(key).orderBy("at")  # one robots file: at most 512 KiB
    marked = lines.filter(F.col("name").isin("user-agent", "allow", "disallow"))
    is_rule = F.col("name").isin("allow", "disallow") & (F.col("value") != "")
    marked = marked.withColumn("rules_so_far", F.coalesce(F.sum(is_rule.cast("int")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    last_rules = F.last(F.when(F.col("name") == "user-agent", F.col("rules_so_far")), ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, -1))
    agent = F.col("name") == "user-agent"
    opens = agent & (last_rules.isNull() | (F.col("rules_so_far") > last_rules))
    grouped = marked.withColumn("opens", opens.cast("int")).withColumn("grp", F.sum("opens").over(own)).filter("grp > 0")
    agents = grouped.filter("name = 'user-agent' and value <> ''").select(key, "grp", F.lower("value").alias("agent")).distinct()
    named = F.lit(False)
    for t in tokens:
        named = named | F.startswith(F.lit(t.lower()), F.col("agent"))
    matched = agents.filter((F.col("agent") != "*") & named).select(key, "grp").distinct()
    some = matched.select(key).distinct()
    fallback = agents.filter("agent = '*'").select(key, "grp").distinct().join(some, key, "left_anti")
    rules = grouped.filter(is_rule).join(matched.union(fallback), [key, "grp"], "left_semi")
    return rules.select(key, "at", (F.col("name") == "allow").alias("allow"), normal_path(F.col("value")).alias("pattern")), sitemaps


def policies(responses: DataFrame, key: str = "origin") -> DataFrame:
    """(key, deny_all, body): 429, 5xx and failed fetches deny everything; other errors allow everything."""
    deny = F.col("status").isNull() | (F.col("status") == 429) | (F.col("status") >= 500)
    return responses.select(key, deny.alias("deny_all"), F.when(~deny & (F.col("status") < 400), limited_body(F.col("body"))).alias("body"))


def allowed(pages: DataFrame, rules: DataFrame, key: str = "origin", url: str = "url", denied: DataFrame | None = None) -> DataFrame:
    """``pages`` with ``allowed``: of the matching rules the most specific decides, of equal ones an allowing one; no match allows.
    The rules of an origin are few; they are collected into one row per origin and tried in place."""
    per_origin = rules.groupBy(key).agg(F.collect_list(F.struct("allow", rule_regex(F.col("pattern")).alias("regex"), specificity(F.col("pattern")).alias("weight"))).alias("rules__"))
    joined = pages.join(per_origin, key, "left")
    if denied is not None:
        joined = joined.join(denied.select(key, F.lit(True).alias("denied__")).distinct(), key, "left")
    else:
        joined = joined.withColumn("denied__", F.lit(None).cast("boolean"))

    def judge(x: Column) -> Column:
        hits = F.filter(x["rules"], lambda r: F.rlike(x["path"], r["regex"]))
        best = F.array_max(F.transform(hits, lambda r: F.struct(r["weight"].alias("weight"), r["allow"].alias("allow"))))
        return F.coalesce(best["allow"], F.lit(True))

    def look(p: Column) -> Column:
        asked = normal_path(F.concat(p["path"], F.when(p["query"] != "", F.concat(F.lit("?"), p["query"])).otherwise("")))
        verdict = urls.let(F.struct(asked.alias("path"), F.col("rules__").alias("rules")), judge)
        return F.when(p["host"] == "", F.lit(False)).when(F.lower(p["path"]) == "/robots.txt", F.lit(True)).otherwise(F.when(F.col("rules__").isNull(), F.lit(True)).otherwise(verdict))

    out = F.when(F.coalesce("denied__", F.lit(False)), F.lit(False)).otherwise(urls.let(urls.parts(F.col(url)), look))
    return joined.withColumn("allowed", out).drop("rules__", "denied__")
