"""Seed lists, crawl tables and captured responses as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raqim.functions import urls
from raqim.functions.text import SPACE, trim

#: Captured responses stand in for every fetch.
RESPONSES = T.StructType(
    [T.StructField(n, t) for n, t in (("url", T.StringType()), ("method", T.StringType()), ("status", T.IntegerType()), ("final_url", T.StringType()), ("content_type", T.StringType()), ("body", T.BinaryType()), ("duration_ms", T.LongType()), ("attempt", T.IntegerType()), ("error", T.StringType()))]
)


def seeds(lines: DataFrame, column: str = "value") -> DataFrame:
    """Canonical URLs of a seed list: comments and blank lines dropped, duplicates once, in order of appearance by URL."""
    text = trim(F.regexp_replace(F.col(column), f"{SPACE}+#.*$", ""))
    kept = lines.select(text.alias("line")).filter((F.col("line") != "") & ~F.startswith("line", F.lit("#")))
    return kept.select(urls.canonical_seed(F.col("line")).alias("url")).filter("url <> ''").distinct()


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    return seeds(spark.read.text(path))


def batch_scan(queue: DataFrame, mode: str = "batch", limit: int = 1000, attempts: int = 2) -> DataFrame:
    """Rows of a queue to work on: none, all, or the first of the pending ones; where none is pending, of those to review."""
    if mode == "none":
        return queue.limit(0)
    if mode == "full":
        return queue.orderBy("id")
    pending = queue.filter("crawl_status = 'pending'").orderBy("id").limit(limit)
    if not pending.isEmpty():
        return pending
    return queue.filter((F.col("crawl_status") == "needs_review") & (F.col("crawl_attempts") < attempts)).orderBy("id").limit(limit)


def latest_response(responses: DataFrame) -> DataFrame:
    """The last attempt of each URL and method."""
    return responses.groupBy("url", "method").agg(F.max_by(F.struct(*[c for c in responses.columns if c not in ("url", "method")]), F.coalesce("attempt", F.lit(0))).alias("r")).select("url", "method", "r.*")


def rendered(pages: DataFrame) -> DataFrame:
    """The render cascade over captured columns html, interactive, dumped and should_hydrate: the method and the document."""
    method = F.when(~F.col("should_hydrate"), "http").when(F.coalesce("interactive", F.lit("")) != "", "browser_interactive").when(F.coalesce("dumped", F.lit("")) != "", "browser_dump_dom").when(F.coalesce("html", F.lit("")) != "", "http_only").otherwise("unavailable")
    document = F.when(method == "browser_interactive", F.concat_ws("\n", "html", "interactive")).when(method == "browser_dump_dom", F.concat_ws("\n", "html", "dumped")).otherwise(F.coalesce("html", F.lit("")))
    return pages.withColumn("method", method).withColumn("document", document)
