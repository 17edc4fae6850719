"""Which URLs a site's discovery takes in, and why not: one expression whose first failing rule names the reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from raqim.functions import urls

# Files, paths and language codes that are no pages in Arabic.
ASSET = r"(?i)\.(?:7z|apk|avi|bin|css|csv|doc|docx|exe|gif|gz|ico|iso|jpe?g|js|json|m3u8|m4a|mp3|mp4|pdf|png|ppt|pptx|rar|rss|svg|tar|txt|webp|woff2?|xls|xlsx|xml|zip)(?:$|[?#])"
ADMIN = r"(?i)(?:^|/)(?:admin|administrator|api|cart|checkout|comment|comments|feed|feeds|filter|login|logout|search|wp-admin|wp-json)(?:/|$)"
INFORMATION = r"(?i)(?:^|/)(?:about(?:-us)?|contact(?:-us)?|privacy(?:-policy)?|terms(?:-of-service)?|من[-_ ]?نحن|اتصل[-_ ]?بنا|تواصل[-_ ]?معنا|سياسة[-_ ]?الخصوصية|الشروط[-_ ]?والأحكام)(?:/|$)"
SITEMAP = r"(?i)(?:^|/)(?:sitemap(?:[-_].*)?|feed|rss|atom)(?:\.xml)?$"
SEARCH = r"(?i)(?:^|/)(?:search|find|query)(?:/|$)"
CODES = "en|fr|de|es|it|pt|ru|zh|ja|ko|tr|ur|bn|id|ms|fa|sw|nl|pl|th|az|ku|hi|ta|te|uk"
NAMES = "english|french|german|spanish|portuguese|russian|chinese|japanese|korean|turkish|urdu|bengali|indonesian|malay|persian|swahili|dutch|polish|thai|hindi|tamil|telugu|ukrainian|somali"
PREFIX = rf"(?i)^(?:{CODES}|{NAMES})(?:[-_][a-z]{{2,4}})?$"
SUFFIX = rf"(?i)(?:{NAMES})$"
SEGMENT = rf"(?i)^(?:{CODES}|ar-[a-z]{{2}})$"
ARABIC_VALUE = r"(?i)^(?:ar|arabic)(?:[-_.]|$)"


def _foreign(query: Column, keys: tuple[str, ...]) -> Column:
    """Whether one of the parameters names a language other than Arabic, keys and values percent-decoded; the first of a key's values counts."""
    plain = lambda x: F.coalesce(F.try_url_decode(x), x)
    pairs = F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), lambda x: F.struct(plain(F.regexp_extract(x, "^([^=]*)", 1)).alias("k"), plain(F.regexp_extract(x, "^[^=]*=(.*)$", 1)).alias("v")))
    of = lambda rows, k: F.coalesce(F.get(F.filter(rows, lambda x: x["k"] == k), F.lit(0))["v"], F.lit(""))

    def judge(rows: Column) -> Column:
        out = F.lit(False)
        for k in keys:
            out = out | ((of(rows, k) != "") & ~F.rlike(of(rows, k), F.lit(ARABIC_VALUE)))
        return out

    return F.when(F.coalesce(query, F.lit("")) == "", False).otherwise(urls.let(pairs, judge))


def decision(raw: Column, site: Column, arabic_first: tuple[str, ...] = ("quran.com",)) -> Column:
    """struct(url, reason): the canonical URL and a null reason, or '' and the first reason against it."""
    like = lambda c, pattern: F.rlike(c, F.lit(pattern))

    def judge(x: Column) -> Column:
        u, p, s, full = x["u"], x["p"], x["s"], x["full"]
        parts = F.filter(F.split(p["path"], "/"), lambda y: y != "")
        decoded = F.try_url_decode(F.replace(p["path"], F.lit("+"), F.lit("%2B")))
        return urls.let(F.struct(F.lower(decoded).alias("path"), parts.alias("parts"), F.coalesce(F.get(parts, F.lit(0)), F.lit("")).alias("first"), u.alias("u"), p.alias("p"), s.alias("s"), full.alias("full")), reasons)

    def reasons(x: Column) -> Column:
        path, p, s, u, first = x["path"], x["p"], x["s"], x["u"], x["first"]
        special = p["bare"].isin(*arabic_first) if arabic_first else F.lit(False)
        tafsir = F.array_position(F.transform(x["parts"], lambda y: like(y, "(?i)^tafsirs?$")), True)
        after = F.coalesce(F.get(x["parts"], tafsir.cast("int")), F.lit(""))
        mark = chr(0xFFFD)
        reason = (
            F.when((s["host"] == "") | (x["full"] == "") | ~like(x["full"], urls.SCHEME), "invalid_url")
            .when(~F.lower(F.regexp_extract(x["full"], urls.SCHEME, 1)).isin("http", "https"), "unsupported_scheme")
            .when(u == "", "invalid_url")
            .when(p["bare"] != s["bare"], "external_host")
            .when(p["port"] != s["port"], "different_port")
            .when(path.isNull() | ((F.instr(path, mark) > 0) & (F.instr(F.upper(p["path"]), "%EF%BF%BD") == 0)), "invalid_path_encoding")
            .when(path == "/robots.txt", "robots_file")
            .when(like(path, ASSET), "asset_file")
            .when(like(path, ADMIN), "administrative_or_feed_path")
            .when(like(path, INFORMATION), "noncontent_information_path")
            .when(like(path, SITEMAP), "sitemap_or_feed_path")
            .when(like(path, SEARCH), "search_results_path")
            .when(like(first, PREFIX), "non_arabic_language")
            .when(F.exists(x["parts"], lambda y: like(y, SUFFIX)), "non_arabic_language_suffix")
            .when(_foreign(p["query"], ("lang", "locale", "language")), "non_arabic_language_parameter")
            .when(special & like(first, SEGMENT), "non_arabic_language")
            .when(special & like(p["path"], r"(?i)(?:^|/)translations?(?:/|$)"), "non_arabic_translation_route")
            .when(special & (tafsir > 0) & ~like(after, r"(?i)^(?:ar(?:-|$)|arabic)"), "non_arabic_tafsir_route")
            .when(special & _foreign(p["query"], ("translation", "tafsir")), "non_arabic_language_parameter")
        )
        rest = F.when(p["query"] == "", "").otherwise(F.concat(F.lit("?"), p["query"]))
        root = F.regexp_extract(u, r"^([^/]+//[^/?#]*)", 1)
        routed = F.when(special & (F.lower(first) != "ar"), F.concat(root, F.lit("/ar"), F.when(p["path"] == "/", "").otherwise(p["path"]), rest)).otherwise(u)
        return urls.let(F.struct(reason.alias("reason"), routed.alias("url")), lambda y: F.struct(F.when(y["reason"].isNull(), y["url"]).otherwise("").alias("url"), y["reason"].alias("reason")))

    def canonical(y: Column) -> Column:
        return urls.let(F.struct(y["full"].alias("full"), y["u"].alias("u"), urls.parts(y["u"]).alias("p"), urls.parts(site).alias("s")), judge)

    return urls.let(urls.resolve(raw, site), lambda full: urls.let(F.struct(full.alias("full"), urls.canonical_discovery(full).alias("u")), canonical))


def is_page(raw: Column, site: Column) -> Column:
    """The canonical URL of a page that is taken in, else ''."""
    return decision(raw, site)["url"]
