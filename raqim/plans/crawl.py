"""Queries over sites, the queue and attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raqim.functions import urls
from raqim.operators import extract, queue, state
from raqim.plans import sqltext as S
from raqim.session import table

METADATA = T.StructType([T.StructField("httpStatus", T.IntegerType()), T.StructField("contentType", T.StringType()), T.StructField("fetchMethod", T.StringType()), T.StructField("durationMs", T.LongType())])


def attempts(spark: SparkSession, d: str) -> DataFrame:
    """Attempts with their metadata read: broken or missing JSON gives nulls."""
    rows = table(spark, d, "crawler_attempts")
    read = lambda path, kind: F.expr(f"try_cast(get_json_object(metadata, '$.{path}') as {kind})")
    valid = F.expr("try_parse_json(metadata)").isNotNull()
    return rows.withColumns({"http_status": F.when(valid, read("httpStatus", "int")), "content_type": F.when(valid, read("contentType", "string")), "fetch_method": F.when(valid, read("fetchMethod", "string")), "duration_ms": F.when(valid, read("durationMs", "bigint"))})


_ATTEMPTS = """a AS (SELECT * EXCLUDE (metadata), CASE WHEN json_valid(metadata) THEN metadata END AS m FROM crawler_attempts),
  r AS (SELECT *, TRY_CAST(json_extract_string(m, '$.httpStatus') AS INTEGER) AS http_status, json_extract_string(m, '$.contentType') AS content_type, json_extract_string(m, '$.fetchMethod') AS fetch_method, TRY_CAST(json_extract_string(m, '$.durationMs') AS BIGINT) AS duration_ms FROM a)"""


def attempt_metadata(spark: SparkSession, d: str) -> DataFrame:
    return attempts(spark, d).select("id", "http_status", "content_type", "fetch_method", "duration_ms")


def _code(df: DataFrame) -> DataFrame:
    return df.withColumn("code", extract.error_code(F.col("error"), F.col("http_status"), F.col("content_type"), F.lit(None).cast("string")))


def error_codes(spark: SparkSession, d: str) -> DataFrame:
    return _code(attempts(spark, d)).select("id", "code")


def failure_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Why attempts of each site failed, among those that weren't completed."""
    return _code(attempts(spark, d).filter("status <> 'completed'")).groupBy("site_id", "status", "code").agg(F.count("*").alias("n"), F.sum("duration_ms").alias("duration_ms"))


_CODE = """CASE WHEN error IS NOT NULL AND error <> '' THEN CASE WHEN contains(error, 'timeout') THEN 'timeout' ELSE 'fetch_error' END WHEN http_status = 404 THEN 'not_found' WHEN http_status = 403 THEN 'forbidden'
  WHEN http_status = 429 THEN 'rate_limited' WHEN http_status >= 400 THEN 'http_' || http_status WHEN NOT regexp_matches(coalesce(content_type, ''), '(?i)html') THEN 'not_html' ELSE 'unknown' END"""


def review_reasons(spark: SparkSession, d: str) -> DataFrame:
    rows = attempts(spark, d)
    reason = extract.review_reason(F.col("error"), F.col("http_status"), F.col("content_type"), F.lit("good"), F.lit(1), F.array(F.lit("keywords")))
    return rows.select("id", reason.alias("reason"))


_REASON = """CASE WHEN error IS NOT NULL AND error <> '' THEN CASE WHEN contains(error, 'timeout') THEN 'fetch_timeout' ELSE 'fetch_error' END
  WHEN NOT (coalesce(http_status, 0) BETWEEN 200 AND 399) THEN 'http_' || CASE WHEN coalesce(http_status, 0) = 0 THEN 'unknown' ELSE CAST(http_status AS VARCHAR) END
  WHEN NOT regexp_matches(coalesce(content_type, ''), '(?i)html') THEN 'not_html' ELSE 'missing_keywords' END"""


def attempt_days(spark: SparkSession, d: str) -> DataFrame:
    """Attempts by day and status, whole-row repeats counted once: how many, how many sites, median duration."""
    rows = attempts(spark, d).dropDuplicates(["id"])
    return rows.groupBy(F.date_format("started_at", "yyyy-MM-dd").alias("day"), "status").agg(F.count("*").alias("attempts"), F.countDistinct("site_id").alias("sites"), F.max("duration_ms").alias("slowest_ms"))


def site_overview(spark: SparkSession, d: str) -> DataFrame:
    """Each site with what waits, what failed and what is indexed; the parts are aggregated before they are joined."""
    sites = table(spark, d, "crawler_sites").select(F.col("id").alias("site_id"), "category", "crawl_status", urls.bare_host(F.col("url")).alias("host"))
    waiting = table(spark, d, "crawler_queue").dropDuplicates(["id"]).groupBy("site_id").agg(F.count("*").alias("queued"), F.sum("crawl_attempts").alias("queue_attempts"))
    tried = table(spark, d, "crawler_attempts").dropDuplicates(["id"]).groupBy("site_id").agg(F.count("*").alias("attempts"), F.sum(F.when(F.col("status") == "completed", 1).otherwise(0)).alias("completed"))
    indexed = table(spark, d, "crawler_results").groupBy(urls.bare_host(F.col("url")).alias("host")).agg(F.count("*").alias("results"), F.max("updated_at").alias("last_update"))
    joined = sites.join(waiting, "site_id", "left").join(tried, "site_id", "left").join(indexed, "host", "left")
    zero = F.lit(0).cast("long")
    return joined.select("site_id", "host", "category", "crawl_status", *(F.coalesce(c, zero).alias(c) for c in ("queued", "queue_attempts", "attempts", "completed", "results")), "last_update")


_OVERVIEW = f"""WITH h AS (SELECT *, regexp_replace(lower(regexp_extract(regexp_extract({S.trim('url')}, {S.q(urls.AUTHORITY)}, 1), {S.q(urls.HOST)}, 1)), '^www\\.', '') AS host FROM crawler_sites),
  w AS (SELECT site_id, count(*) AS queued, CAST(sum(crawl_attempts) AS BIGINT) AS queue_attempts FROM (SELECT DISTINCT ON (id) * FROM crawler_queue) GROUP BY site_id),
  t AS (SELECT site_id, count(*) AS attempts, count(*) FILTER (status = 'completed') AS completed FROM (SELECT DISTINCT ON (id) * FROM crawler_attempts) GROUP BY site_id),
  x AS (SELECT regexp_replace(lower(regexp_extract(regexp_extract({S.trim('url')}, {S.q(urls.AUTHORITY)}, 1), {S.q(urls.HOST)}, 1)), '^www\\.', '') AS host, count(*) AS results, max(updated_at) AS last_update FROM crawler_results GROUP BY 1)
  SELECT h.id AS site_id, h.host, category, crawl_status, coalesce(queued, 0) AS queued, coalesce(queue_attempts, 0) AS queue_attempts, coalesce(attempts, 0) AS attempts, coalesce(completed, 0) AS completed, coalesce(results, 0) AS results, last_update
  FROM h LEFT JOIN w ON w.site_id = h.id LEFT JOIN t ON t.site_id = h.id LEFT JOIN x ON x.host = h.host"""


def _queue(spark: SparkSession, d: str) -> DataFrame:
    """The queue without its whole-row repeats."""
    return table(spark, d, "crawler_queue").dropDuplicates(["id"])


_QUEUE = "q AS (SELECT DISTINCT * FROM crawler_queue)"


def acquire_batch(spark: SparkSession, d: str) -> DataFrame:
    return queue.acquire(_queue(spark, d), 20).select("id", "url", "crawl_status", "crawl_attempts", "phase")


def claim_batch(spark: SparkSession, d: str) -> DataFrame:
    return queue.claim(_queue(spark, d), 50, "worker-x").select("id", "url", "worker_id", "crawl_status", "crawl_attempts")


def finished(spark: SparkSession, d: str) -> DataFrame:
    """The queue after every page in process was finished as completed."""
    rows = _queue(spark, d)
    done = rows.filter("crawl_status = 'processing'").select("id", F.lit("completed").alias("status"))
    return queue.finish(rows, done).select("id", "crawl_status", "worker_id")


def batch_scan(spark: SparkSession, d: str) -> DataFrame:
    from raqim.sources import seeds

    return seeds.batch_scan(_queue(spark, d), "batch", 100).select("id", "url", "crawl_status")


def recover_stale(spark: SparkSession, d: str) -> DataFrame:
    """Leases that have run out half an hour before the newest change of the queue."""
    rows = _queue(spark, d)
    now = rows.agg(F.max("updated_at").alias("now__"))
    return queue.recover(rows.crossJoin(F.broadcast(now)), F.col("now__")).filter("recovered").select("id", "crawl_status", "worker_id")


def outcome_route(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of each queued page by its last attempt."""
    last = attempts(spark, d).filter("queue_id is not null").dropDuplicates(["id"])
    last = last.withColumn("r", F.row_number().over(Window.partitionBy("queue_id").orderBy(F.desc("started_at"), F.desc("id")))).filter("r = 1")
    complete = F.coalesce(F.col("error").isNull() & F.col("http_status").between(200, 399) & F.col("content_type").rlike("(?i)html"), F.lit(False))
    rows = _queue(spark, d).select(F.col("id").alias("queue_id"), "crawl_status", "crawl_attempts").join(last.select("queue_id", "error", "http_status", "content_type"), "queue_id")
    phase = F.when(F.col("crawl_status") == "needs_review", "review").otherwise("pending")
    return rows.select("queue_id", queue.outcome(complete, phase, F.col("crawl_attempts")).alias("outcome"))


def page_cap(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 queued pages of each site, and how many of the site stay behind."""
    return queue.capped(_queue(spark, d).select("site_id", "id", "url"), 50, "site_id", ("id",)).select("site_id", "id", "left")


def progress(spark: SparkSession, d: str) -> DataFrame:
    """At which of its attempts a site passes each fifth."""
    rows = table(spark, d, "crawler_attempts").filter("site_id is not null").dropDuplicates(["id"])
    return queue.milestones(rows.select("id", "site_id"), "id", 20, "site_id").select("site_id", "id", F.col("n").cast("long").alias("n"), "percent")


def new_pages(spark: SparkSession, d: str) -> DataFrame:
    """Queued pages whose canonical URL isn't indexed yet, each once."""
    rows = _queue(spark, d).select("id", "site_id", urls.canonical_discovery(F.col("url")).alias("url"))
    indexed = table(spark, d, "crawler_results").select(urls.canonical_discovery(F.col("url")).alias("url")).distinct()
    return state.insert_or_ignore(indexed, rows, "url").select("id", "site_id", "url")


def stale_queue(spark: SparkSession, d: str) -> DataFrame:
    """Queue numbers that attempts name but the queue doesn't hold any more."""
    tried = table(spark, d, "crawler_attempts").filter("queue_id is not null").select(F.col("queue_id").alias("id")).distinct()
    return state.stale(tried, _queue(spark, d))


def integrity(spark: SparkSession, d: str) -> DataFrame:
    tables = {n: table(spark, d, f"crawler_{n}") for n in ("sites", "queue", "attempts", "results")}
    return state.integrity(tables, {"sites": ["id", "url"], "queue": ["id", "url"], "results": ["id", "url"], "attempts": ["id"]}, [("queue", "site_id", "sites", "id"), ("attempts", "site_id", "sites", "id")])


_INTEGRITY = " UNION ALL ".join(
    [f"SELECT 'unique' AS \"check\", '{t}.{k}' AS subject, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS violations FROM (SELECT count(*) AS n FROM crawler_{t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)" for t, k in (("sites", "id"), ("sites", "url"), ("queue", "id"), ("queue", "url"), ("results", "id"), ("results", "url"), ("attempts", "id"))]
    + [f"SELECT 'reference', '{t}.site_id', count(*) FROM crawler_{t} WHERE site_id IS NOT NULL AND site_id NOT IN (SELECT id FROM crawler_sites)" for t in ("queue", "attempts")]
)


def row_counts(spark: SparkSession, d: str) -> DataFrame:
    names = ("sites", "queue", "attempts", "results")
    out = None
    for n in names:
        one = table(spark, d, f"crawler_{n}").agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n")
        out = one if out is None else out.union(one)
    return out


def cursors(spark: SparkSession, d: str) -> DataFrame:
    """The resume cursors, tolerantly read: lists without repeats, the current sitemap, the page index."""
    rows = table(spark, d, "crawler_sites").select("id", "discovery_cursor")
    valid = F.expr("try_parse_json(discovery_cursor)").isNotNull()
    text_ = F.when(valid, F.col("discovery_cursor"))
    lists = F.from_json(text_, "pendingSitemaps array<string>, seenSitemaps array<string>, currentSitemap string, currentPageIndex int, robotsStatus string")
    read = rows.select("id", lists.alias("c"))
    size = lambda c: F.coalesce(F.size(F.array_distinct(F.filter(F.transform(F.col(c), lambda x: urls.sitemap_form(x)), lambda x: x != ""))), F.lit(0)).cast("long")
    n = lambda c: F.when(F.col(c).isNull(), F.lit(0).cast("long")).otherwise(size(c))
    current = F.nullif(urls.sitemap_form(F.col("c.currentSitemap")), F.lit(""))
    return read.select("id", n("c.pendingSitemaps").alias("pending"), n("c.seenSitemaps").alias("seen"), current.alias("current"), F.coalesce("c.currentPageIndex", F.lit(0)).alias("page_index"), F.col("c.robotsStatus").alias("robots_status"))


_SITEMAP = lambda c: f"regexp_replace({c}, '^(https?://)www\\.', '\\1')"
_CURSORS = f"""WITH c AS (SELECT id, CASE WHEN json_valid(discovery_cursor) THEN discovery_cursor END AS j FROM crawler_sites)
  SELECT id, coalesce(len(list_distinct(list_transform(CAST(json_extract(j, '$.pendingSitemaps') AS VARCHAR[]), lambda x: {_SITEMAP('x')}))), 0) AS pending, coalesce(len(list_distinct(list_transform(CAST(json_extract(j, '$.seenSitemaps') AS VARCHAR[]), lambda x: {_SITEMAP('x')}))), 0) AS seen,
  {_SITEMAP("nullif(json_extract_string(j, '$.currentSitemap'), '')")} AS current, coalesce(TRY_CAST(json_extract_string(j, '$.currentPageIndex') AS INTEGER), 0) AS page_index, json_extract_string(j, '$.robotsStatus') AS robots_status FROM c"""

QUERIES: dict[str, tuple] = {
    "site_overview": (site_overview, _OVERVIEW),
    "attempt_metadata": (attempt_metadata, f"WITH {_ATTEMPTS} SELECT id, http_status, content_type, fetch_method, duration_ms FROM r"),
    "error_codes": (error_codes, f"WITH {_ATTEMPTS} SELECT id, {_CODE} AS code FROM r"),
    "failure_histogram": (failure_histogram, f"WITH {_ATTEMPTS} SELECT site_id, status, {_CODE} AS code, count(*) AS n, CAST(sum(duration_ms) AS BIGINT) AS duration_ms FROM r WHERE status <> 'completed' GROUP BY ALL"),
    "review_reasons": (review_reasons, f"WITH {_ATTEMPTS} SELECT id, {_REASON} AS reason FROM r"),
    "attempt_days": (attempt_days, f"WITH {_ATTEMPTS}, u AS (SELECT DISTINCT ON (id) * FROM r) SELECT strftime(started_at AT TIME ZONE 'UTC', '%Y-%m-%d') AS day, status, count(*) AS attempts, count(DISTINCT site_id) AS sites, max(duration_ms) AS slowest_ms FROM u GROUP BY ALL"),
    "acquire_batch": (
        acquire_batch,
        f"""WITH {_QUEUE}, t AS (SELECT *, CASE WHEN coalesce(crawl_status, 'pending') IN ('pending', 'queued', 'processing') THEN 1 WHEN crawl_status = 'needs_review' AND coalesce(crawl_attempts, 0) < 2 THEN 2 END AS tier FROM q), b AS (SELECT *, min(tier) OVER () AS best FROM t WHERE tier IS NOT NULL)
          SELECT id, url, crawl_status, crawl_attempts, CASE WHEN tier = 1 THEN 'pending' ELSE 'review' END AS phase FROM b WHERE tier = best ORDER BY id LIMIT 20""",
    ),
    "claim_batch": (claim_batch, f"WITH {_QUEUE} SELECT id, url, 'worker-x' AS worker_id, 'processing' AS crawl_status, crawl_attempts + 1 AS crawl_attempts FROM q WHERE crawl_status IN ('pending', 'queued') ORDER BY id LIMIT 50"),
    "finished": (finished, f"WITH {_QUEUE} SELECT id, CASE WHEN crawl_status = 'processing' THEN 'completed' ELSE crawl_status END AS crawl_status, CASE WHEN crawl_status = 'processing' THEN NULL ELSE worker_id END AS worker_id FROM q"),
    "batch_scan": (batch_scan, f"WITH {_QUEUE}, t AS (SELECT *, count(*) FILTER (crawl_status = 'pending') OVER () AS pending FROM q) SELECT id, url, crawl_status FROM t WHERE CASE WHEN pending > 0 THEN crawl_status = 'pending' ELSE crawl_status = 'needs_review' AND crawl_attempts < 2 END ORDER BY id LIMIT 100"),
    "recover_stale": (recover_stale, f"WITH {_QUEUE}, n AS (SELECT max(updated_at) AS now FROM q) SELECT id, 'pending' AS crawl_status, CAST(NULL AS VARCHAR) AS worker_id FROM q, n WHERE crawl_status = 'processing' AND processing_started_at < now - INTERVAL 30 MINUTE"),
    "outcome_route": (
        outcome_route,
        f"""WITH {_QUEUE}, {_ATTEMPTS}, l AS (SELECT * FROM (SELECT DISTINCT ON (id) * FROM r) WHERE queue_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY queue_id ORDER BY started_at DESC, id DESC) = 1)
          SELECT l.queue_id, CASE WHEN error IS NULL AND http_status BETWEEN 200 AND 399 AND regexp_matches(content_type, '(?i)html') THEN 'indexed' WHEN q.crawl_status = 'needs_review' OR coalesce(q.crawl_attempts, 0) >= 2 THEN 'corrupt' ELSE 'needs_review' END AS outcome FROM q JOIN l ON l.queue_id = q.id""",
    ),
    "page_cap": (page_cap, f'WITH {_QUEUE}, n AS (SELECT site_id, id, row_number() OVER (PARTITION BY site_id ORDER BY id) AS n, count(*) OVER (PARTITION BY site_id) AS c FROM q) SELECT site_id, id, greatest(c - 50, 0) AS "left" FROM n WHERE n <= 50'),
    "progress": (
        progress,
        """WITH u AS (SELECT DISTINCT id, site_id FROM crawler_attempts WHERE site_id IS NOT NULL), n AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY id) AS n, count(*) OVER (PARTITION BY site_id) AS c FROM u),
          p AS (SELECT *, CAST(floor(100 * n / c) AS INTEGER) AS percent FROM n), m AS (SELECT *, percent // 20 * 20 AS reached FROM p), w AS (SELECT *, coalesce(lag(reached) OVER (PARTITION BY site_id ORDER BY id), 0) AS before FROM m)
          SELECT site_id, id, n, percent FROM w WHERE reached > before""",
    ),
    "new_pages": (
        new_pages,
        f"""WITH {_QUEUE}, {S.url_parts('q', 'url', 'id, site_id')}, c AS (SELECT id, site_id, {S.canonical_discovery()} AS url FROM parts), x AS (WITH {S.url_parts('crawler_results', 'url', 'id')} SELECT DISTINCT {S.canonical_discovery()} AS url FROM parts)
          SELECT id, site_id, url FROM c WHERE url NOT IN (SELECT url FROM x) QUALIFY row_number() OVER (PARTITION BY url ORDER BY id) = 1""",
    ),
    "stale_queue": (stale_queue, "SELECT DISTINCT queue_id AS id FROM crawler_attempts WHERE queue_id IS NOT NULL AND queue_id NOT IN (SELECT id FROM crawler_queue)"),
    "integrity": (integrity, _INTEGRITY),
    "row_counts": (row_counts, " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM crawler_{n}" for n in ("sites", "queue", "attempts", "results"))),
    "cursors": (cursors, _CURSORS),
}
