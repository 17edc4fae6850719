"""The write side of the search store: rows, display table, text table, inverted index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raqim.functions import text, urls

MAX_TEXT, MAX_ROWS = 20_000, 100


def rows(records: DataFrame) -> DataFrame:
    """Records with the index's url, title, description, icon_url and search_text; ``valid`` tells whether they can be stored.
    Other columns stay; missing ones of url, page_url, site_url, domain, snippet and content count as empty."""

    def field(*names: str) -> Column:
        have = [F.nullif(F.col(n), F.lit("")) for n in names if n in records.columns]
        return F.coalesce(*have, F.lit("")) if have else F.lit("")

    clean = lambda c: text.collapse(c, MAX_TEXT)
    keep = [c for c in records.columns if c not in ("url", "title", "description", "icon_url", "keywords", "snippet", "content", "page_url", "site_url", "domain")]
    cleaned = F.struct(
        urls.page_url(field("url", "page_url", "site_url", "domain")).alias("url"), clean(field("title")).alias("title"), clean(field("description")).alias("description"), clean(field("keywords")).alias("keywords"),
        clean(field("snippet", "content")).alias("snippet"), clean(field("icon_url")).alias("icon_url"),
    )

    def build(x: Column) -> Column:
        parts = F.filter(F.array(x["title"], x["description"], x["keywords"], x["snippet"], urls.site_domain(x["url"])), lambda y: y != "")
        named = lambda t: F.struct(x["url"].alias("url"), x["title"].alias("title"), x["description"].alias("description"), x["icon_url"].alias("icon_url"), t.alias("search_text"), ((x["url"] != "") & (t != "")).alias("valid"))
        return urls.let(clean(F.array_join(parts, " ")), named)

    # one expression with bound parts: a filter on ``valid`` that is pushed below it computes each part once more, not many times
    return records.select(*keep, urls.let(cleaned, build).alias("row__")).select(*keep, "row__.*")


RECORD = "url string, page_url string, site_url string, domain string, title string, description string, keywords string, snippet string, content string, icon_url string"


def read_requests(requests: DataFrame, request: str, body: str = "body") -> DataFrame:
    """(request, pos, fields of RECORD) of JSON requests: an array of rows, an object with ``rows``, or one row.
    Requests that aren't JSON, and those of no row or more than 100, give nothing."""
    text_ = F.col(body)
    listed = F.from_json(text_, f"array<struct<{RECORD.replace(' string', ': string')}>>")
    inside = F.from_json(text_, f"rows array<struct<{RECORD.replace(' string', ': string')}>>")["rows"]
    single = F.array(F.from_json(text_, RECORD))
    rows_ = F.when(text_.rlike(r"^\s*\["), listed).when(F.get_json_object(text_, "$.rows").rlike(r"^\s*\["), inside).when(F.expr(f"try_parse_json({body})").isNotNull() & text_.rlike(r"^\s*\{"), single)
    kept = requests.select(request, rows_.alias("rows__")).filter(F.size("rows__").between(1, MAX_ROWS))
    return kept.select(request, F.posexplode("rows__").alias("pos", "r")).select(request, "pos", "r.*")


def chunks(rows_: DataFrame, size: int = MAX_ROWS) -> DataFrame:
    """``rows_`` with ``chunk``, a number shared by at most ``size`` neighbouring rows of one partition: no shuffle, no global order."""
    number = F.monotonically_increasing_id()
    return rows_.withColumn("chunk", F.xxhash64(F.shiftright(number, 33), F.floor(number.bitwiseAND((1 << 33) - 1) / size)))


def accepted(ingest: DataFrame, request: str) -> DataFrame:
    """Rows of requests of 1 to 100 rows that are all valid: one bad row rejects its whole request."""
    per = ingest.groupBy(request).agg(F.bool_and("valid").alias("good"), F.count("*").alias("n")).filter(F.col("good") & (F.col("n") <= MAX_ROWS)).select(request)
    return ingest.join(per, request, "left_semi")


def display(ingest: DataFrame, order: str) -> DataFrame:
    """The display table: the first row of each URL stays."""
    first = Window.partitionBy("url").orderBy(order)
    return ingest.filter("valid").withColumn("r", F.row_number().over(first)).filter("r = 1").select("url", "title", "description", "icon_url")


def search_texts(ingest: DataFrame, order: str) -> DataFrame:
    """The text table: the last row of each URL replaces those before."""
    last = Window.partitionBy("url").orderBy(F.desc(order))
    return ingest.filter("valid").withColumn("r", F.row_number().over(last)).filter("r = 1").select("url", "search_text")


def terms(column: Column) -> Column:
    """Tokens of a text: lower case, runs of letters and digits, Latin accents and Arabic vowel marks removed."""
    folded = F.translate(F.lower(F.regexp_replace(column, text.DIACRITICS, "")), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    return F.filter(F.split(folded, r"[^\p{L}\p{N}]+"), lambda x: x != "")


def inverted(texts: DataFrame) -> DataFrame:
    """(term, url, tf, positions): positions count from 0."""
    each = texts.select("url", F.posexplode(terms(F.col("search_text"))).alias("pos", "term"))
    return each.groupBy("term", "url").agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))


def search(index: DataFrame, query: list[str], texts: int) -> DataFrame:
    """(url, score): documents ranked by the sum of tf times inverse document frequency over the query's terms."""
    own = index.filter(F.col("term").isin(*query))
    df = own.groupBy("term").agg(F.count("*").alias("df"))
    return own.join(F.broadcast(df), "term").groupBy("url").agg(F.sum(F.col("tf") * F.log(F.lit(1 + texts) / F.col("df"))).alias("score"))
