"""Queries over URLs, admission, sitemaps and robots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raqim.functions import admission, robots, urls
from raqim.plans import sqltext as S
from raqim.session import table
from raqim.sources import seeds, sitemaps


def _on(name: str, key: str, expression, out: str):
    """A query that adds one expression of ``url`` to the key of a table."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, name).select(key, expression(F.col("url")).alias(out))

    return run


def _sql(name: str, expression: str, out: str) -> str:
    return f"WITH {S.url_parts(name, 'url', 'id')} SELECT id, {expression} AS {out} FROM parts"


def url_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Pages crawled under several addresses: per canonical URL the number of rows and the least id."""
    rows = table(spark, d, "crawler_results").select("id", urls.canonical_discovery(F.col("url")).alias("url"))
    return rows.groupBy("url").agg(F.count("*").alias("n"), F.min("id").alias("first_id")).filter("n > 1")


def _admitted(spark: SparkSession, d: str) -> DataFrame:
    queue = table(spark, d, "crawler_queue").select("id", "site_id", "url")
    sites = table(spark, d, "crawler_sites").select(F.col("id").alias("site_id"), F.col("url").alias("site"))
    return queue.join(sites, "site_id").withColumn("d", admission.decision(F.col("url"), F.col("site")))


def page_admission(spark: SparkSession, d: str) -> DataFrame:
    return _admitted(spark, d).select("id", "site_id", F.col("d.url").alias("canonical"), F.col("d.reason").alias("reason"))


def admission_histogram(spark: SparkSession, d: str) -> DataFrame:
    return _admitted(spark, d).groupBy("site_id", F.coalesce("d.reason", F.lit("admitted")).alias("reason")).agg(F.count("*").alias("n"))


def admission_of_results(spark: SparkSession, d: str) -> DataFrame:
    """Every result judged as a link found on its neighbour's site, so that foreign hosts occur."""
    rows = table(spark, d, "crawler_results").select("id", "url")
    others = rows.select((F.col("id") + 1).alias("id"), F.col("url").alias("site"))
    return rows.join(others, "id").select("id", admission.decision(F.col("url"), F.col("site"))["reason"].alias("reason"))


_ADMISSION = f"""WITH s AS (SELECT id AS site_id, url AS site FROM crawler_sites), j AS (SELECT q.id, q.site_id, q.url, s.site FROM crawler_queue q JOIN s USING (site_id)),
  {S.url_parts('j', 'url', 'id, site_id, site')},
  sp AS (SELECT *, lower(regexp_extract(regexp_extract(site, {S.q(urls.AUTHORITY)}, 1), {S.q(urls.HOST)}, 1)) AS sh FROM parts),
  judged AS (SELECT *, regexp_replace(sh, '^www\\.', '') AS site_bare, '' AS site_port FROM sp),
  canon AS (SELECT *, {S.canonical_discovery()} AS c FROM judged),
  final AS (SELECT id, site_id, c, {S.reason()} AS reason FROM canon)"""


def sitemap_candidates(spark: SparkSession, d: str) -> DataFrame:
    return sitemaps.candidates(table(spark, d, "crawler_sites").select("id", "url")).select("origin", F.col("pos").cast("long").alias("pos"), "candidate")


def feed_candidates(spark: SparkSession, d: str) -> DataFrame:
    return sitemaps.feed_candidates(table(spark, d, "crawler_sites").select("id", "url")).select("origin", F.col("pos").cast("long").alias("pos"), "candidate")


def _candidates_sql(paths: list[str]) -> str:
    listed = ", ".join(f"({i}, {S.q(p)})" for i, p in enumerate(paths))
    return f"""WITH {S.url_parts('crawler_sites', 'url', 'id')}, o AS (SELECT DISTINCT scheme || '://' || host || {S.AT} AS origin FROM parts WHERE host <> ''), p(pos, path) AS (VALUES {listed})
      SELECT origin, CAST(pos AS BIGINT) AS pos, origin || path AS candidate FROM o CROSS JOIN p"""


#: Three robots files, one of which applies to a site by its number, so that rules, groups and ties all occur.
ROBOTS = (
    "User-agent: *\nDisallow: /blog/\nAllow: /blog/qamar\nSitemap: https://a.example/sitemap.xml\nDisallow: /*suq*$\n",
    "User-agent: other\nDisallow: /\n\nUser-agent: crawler\nUser-agent: someone\nDisallow: /p/\nDisallow:\nAllow: /p/\nDisallow: /news/*river\n",
    "# nothing here\nUser-agent: nobody\nDisallow: /\n",
)


def robots_allowed(spark: SparkSession, d: str) -> DataFrame:
    bodies = spark.createDataFrame(list(enumerate(ROBOTS)), "policy int, body string")
    rules, _ = robots.parse(bodies, "policy", "body", ("crawler",))
    pages = table(spark, d, "crawler_queue").select("id", "url", F.pmod("site_id", F.lit(len(ROBOTS))).cast("int").alias("policy"))
    return robots.allowed(pages, rules, "policy").select("id", "policy", "allowed")


_PATH = f"regexp_extract(url, {S.q(urls.PATH)}, 1) || CASE WHEN regexp_extract(url, {S.q(urls.QUERY)}, 1) <> '' THEN '?' || regexp_extract(url, {S.q(urls.QUERY)}, 1) ELSE '' END"
_ROBOTS_SQL = f"""WITH r(policy, rule, allow, weight) AS (VALUES (0, '^/blog/', false, 6), (0, '^/blog/qamar', true, 11), (0, '^/.*suq.*$', false, 4), (1, '^/p/', false, 3), (1, '^/p/', true, 3), (1, '^/news/.*river', false, 11)),
  p AS (SELECT row_number() OVER () AS n, id, CAST(site_id % 3 AS INTEGER) AS policy, {_PATH} AS path FROM crawler_queue),
  m AS (SELECT p.n, max(weight * 2 + CASE WHEN allow THEN 1 ELSE 0 END) AS best FROM p JOIN r USING (policy) WHERE regexp_matches(p.path, r.rule) GROUP BY p.n)
  SELECT id, policy, coalesce(best % 2 = 1, true) AS allowed FROM p LEFT JOIN m USING (n)"""


def robots_rules(spark: SparkSession, d: str) -> DataFrame:
    bodies = spark.createDataFrame(list(enumerate(ROBOTS)), "policy int, body string")
    return robots.parse(bodies, "policy", "body", ("crawler",))[0].select("policy", "allow", "pattern")


def seed_urls(spark: SparkSession, d: str) -> DataFrame:
    """The sites as a seed list with a comment behind each address."""
    lines = table(spark, d, "crawler_sites").select(F.concat(F.col("url"), F.lit("  # "), F.col("category")).alias("value"))
    return seeds.seeds(lines)


def url_tree(spark: SparkSession, d: str) -> DataFrame:
    """Breadth-first depth of every folder and page below its site's root."""
    from raqim.operators import discover

    pages = table(spark, d, "crawler_results").select(urls.canonical_discovery(F.col("url")).alias("url")).filter("url <> ''").distinct()
    root = F.regexp_extract("url", r"^([^/]+//[^/?#]*)", 1)
    names = F.filter(F.split(F.regexp_extract("url", r"^[^/]+//[^/?#]*([^?#]*)", 1), "/"), lambda x: x != "")
    nodes = F.transform(F.sequence(F.lit(0), F.size("names")), lambda n: F.concat_ws("/", "root", F.array_join(F.slice("names", 1, n), "/")))
    paths = pages.select(root.alias("root"), names.alias("names")).withColumn("nodes", nodes)
    edges = paths.select(F.explode(F.arrays_zip(F.slice("nodes", F.lit(1), F.size("nodes") - 1).alias("parent"), F.slice("nodes", F.lit(2), F.size("nodes")).alias("child"))).alias("e")).select("e.parent", "e.child").filter("parent is not null and child is not null").distinct()
    start = paths.select("root", F.get("nodes", F.lit(0)).alias("node")).distinct()
    return discover.reach(edges, start).select("root", "node", F.col("depth").cast("long").alias("depth"))


_TREE_SQL = f"""WITH RECURSIVE {S.url_parts('crawler_results', 'url', 'id')}, c AS (SELECT DISTINCT {S.canonical_discovery()} AS url FROM parts),
  t AS (SELECT regexp_extract(url, '^([^/]+//[^/?#]*)', 1) AS root, list_filter(string_split(regexp_extract(url, '^[^/]+//[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS names FROM c WHERE url <> ''),
  n AS (SELECT root, names, unnest(range(0, len(names) + 1)) AS k FROM t),
  e AS (SELECT DISTINCT root, root || '/' || array_to_string(names[1:k - 1], '/') AS parent, root || '/' || array_to_string(names[1:k], '/') AS child FROM n WHERE k > 0),
  b AS (SELECT DISTINCT root, root || '/' AS node, 0 AS depth FROM t UNION SELECT b.root, e.child, b.depth + 1 FROM b JOIN e ON e.parent = b.node)
  SELECT root, node, CAST(min(depth) AS BIGINT) AS depth FROM b GROUP BY root, node"""


CHUNK = 1000


def _sitemaps(spark: SparkSession, d: str) -> DataFrame:
    """The results written as sitemaps of at most 1000 ids of one host: (map, base, site, body)."""
    rows = table(spark, d, "crawler_results").select("id", F.col("url"), urls.bare_host(F.col("url")).alias("host"), F.floor(F.col("id") / CHUNK).cast("long").alias("chunk"))
    entry = F.concat(F.lit("<url><loc>"), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("</loc></url>"))
    maps = rows.filter("host <> ''").groupBy("host", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", entry.alias("e")))), lambda x: x["e"]), "").alias("urls"))
    site = F.concat(F.lit("https://"), F.col("host"), F.lit("/"))
    return maps.select(F.concat_ws("#", "host", "chunk").alias("map"), F.concat(site, F.lit("sitemap.xml")).alias("base"), site.alias("site"), F.concat(F.lit('<?xml version="1.0"?><urlset>'), F.col("urls"), F.lit("</urlset>")).alias("body"))


def sitemap_listed(spark: SparkSession, d: str) -> DataFrame:
    return sitemaps.listed(_sitemaps(spark, d), "map", "base", "site").select("map", "format", "kind", "url", "reason")


def sitemap_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages that each sitemap lists, once."""
    return sitemaps.first_seen(sitemaps.listed(_sitemaps(spark, d), "map", "base", "site"), "map").select("map", "kind", "url")


def sitemap_rejections(spark: SparkSession, d: str) -> DataFrame:
    return sitemaps.rejections(sitemaps.listed(_sitemaps(spark, d), "map", "base", "site"), "map")


_LISTED = f"""WITH {S.url_parts('crawler_results', 'url', 'id')}, j AS (SELECT *, bare AS site_bare, '' AS site_port FROM parts WHERE host <> ''), c AS (SELECT *, {S.canonical_discovery()} AS c FROM j),
  l AS (SELECT bare || '#' || CAST(floor(id / {CHUNK}) AS BIGINT) AS map, 'urlset' AS format, c, {S.reason()} AS reason FROM c)"""


def _runs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The results of each host written as an index of sitemaps, discovered by the sites of that host: (sites, walk, pages)."""
    from raqim.operators import discover
    from raqim.session import checkpointed

    maps = _sitemaps(spark, d).select(F.concat("site", F.lit("sitemap-"), F.substring_index("map", "#", -1), F.lit(".xml")).alias("url"), "site", "body")
    entry = F.concat(F.lit("<sitemap><loc>"), F.col("url"), F.lit("</loc></sitemap>"))
    index = maps.groupBy("site").agg(F.array_join(F.array_sort(F.collect_list(entry)), "").alias("x"))
    index = index.select(F.concat("site", F.lit("sitemap.xml")).alias("url"), "site", F.concat(F.lit("<sitemapindex>"), F.col("x"), F.lit("</sitemapindex>")).alias("body"))
    documents = maps.unionByName(index).withColumns({"base": F.col("url"), "ok": F.lit(True), "reason": F.lit(None).cast("string")})
    listed = checkpointed(sitemaps.listed(documents.withColumnRenamed("url", "document"), "document", "base", "site").select(F.col("document").alias("url"), "format", "pos", "kind", F.col("url").alias("target")))
    sites = table(spark, d, "crawler_sites").select("id", "url")
    seeds = sites.select(F.col("id").alias("site_id"), F.concat(F.lit("https://"), urls.bare_host(F.col("url")), F.lit("/sitemap.xml")).alias("url"), F.lit(0).alias("pos"))
    bodies = spark.createDataFrame(list(enumerate(ROBOTS)), "policy int, body string")
    rules = robots.parse(bodies, "policy", "body", ("crawler",))[0]
    rules = sites.select(F.col("id").alias("site_id"), F.pmod("id", F.lit(len(ROBOTS))).cast("int").alias("policy")).join(rules, "policy")
    walk = checkpointed(discover.sitemap_walk(seeds, documents, listed, rules))
    return sites, walk, discover.found_pages(walk, listed, rules=rules)


def discovered_pages(spark: SparkSession, d: str) -> DataFrame:
    return _runs(spark, d)[2].select("site_id", "url")


def discovery_runs(spark: SparkSession, d: str) -> DataFrame:
    from raqim.operators import discover

    sites, walk, pages = _runs(spark, d)
    return discover.runs(sites, walk, pages).select("site_id", "status", "sitemaps", "valid_sitemaps", "pages_added", "feeds_wanted")


_RUNS = f"""WITH {S.url_parts('crawler_results', 'url', 'id')}, j AS (SELECT *, bare AS site_bare, '' AS site_port FROM parts WHERE host <> ''), c AS (SELECT *, {S.canonical_discovery()} AS c FROM j),
  ok AS (SELECT bare, c AS url FROM c WHERE {S.reason()} IS NULL), st AS (WITH {S.url_parts('crawler_sites', 'url', 'id')} SELECT id AS site_id, bare FROM parts),
  r(policy, rule, allow, weight) AS (VALUES (0, '^/blog/', false, 6), (0, '^/blog/qamar', true, 11), (0, '^/.*suq.*$', false, 4), (1, '^/p/', false, 3), (1, '^/p/', true, 3), (1, '^/news/.*river', false, 11)),
  p AS (SELECT DISTINCT site_id, url, {_PATH} AS path FROM ok JOIN st USING (bare)),
  m AS (SELECT site_id, url, max(weight * 2 + CASE WHEN allow THEN 1 ELSE 0 END) AS best FROM p JOIN r ON r.policy = p.site_id % 3 WHERE regexp_matches(path, rule) GROUP BY ALL),
  pages AS (SELECT p.site_id, p.url FROM p LEFT JOIN m USING (site_id, url) WHERE coalesce(best % 2 = 1, true)),
  maps AS (SELECT bare, count(DISTINCT floor(id / {CHUNK})) AS n FROM c GROUP BY bare), n AS (SELECT site_id, count(*) AS pages_added FROM pages GROUP BY site_id)"""
_RUNS_SQL = """SELECT site_id, CASE WHEN coalesce(pages_added, 0) = 0 THEN 'not_pages' ELSE 'completed' END AS status, coalesce(1 + n, 1) AS sitemaps, coalesce(1 + n, 0) AS valid_sitemaps, coalesce(pages_added, 0) AS pages_added,
  coalesce(pages_added, 0) <= 1 AS feeds_wanted FROM st LEFT JOIN maps USING (bare) LEFT JOIN n USING (site_id)"""


#: A document of each format that lists one address, as written in XML or JSON.
FORMATS = {
    "urlset": '<urlset xmlns:xhtml="x"><url><loc>https://elsewhere.example/en/a</loc><xhtml:link rel="alternate" hreflang="ar-EG" href="%x"/></url></urlset>',
    "rss": "<rss><channel><title>t</title><item><title>t</title><link>%x</link></item></channel></rss>",
    "rdf": "<rdf:RDF><item><link><![CDATA[%r]]></link></item></rdf:RDF>",
    "feed": '<feed xmlns="x"><entry><link rel="alternate" href="%x"/><id>1</id></entry></feed>',
    "json": '{"version": 1, "pages": [{"title": "t", "url": %j}]}',
    "url-list": "%r\n\n",
    "sitemapindex": "<sitemapindex><sitemap><loc>%x</loc><lastmod>2024</lastmod></sitemap></sitemapindex>",
}


def sitemap_formats(spark: SparkSession, d: str) -> DataFrame:
    """Each result's address as the only one of a document of every format: (id, format, kind, url, reason)."""
    rows = table(spark, d, "crawler_results").select("id", "url", urls.bare_host(F.col("url")).alias("host")).filter("host <> ''")
    xml = F.replace(F.replace(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    json_ = F.regexp_extract(F.to_json(F.struct("url")), r'^\{"url":(.*)\}$', 1)
    bodies = F.array(*(F.struct(F.lit(name).alias("wanted"), F.replace(F.replace(F.replace(F.lit(body), F.lit("%x"), xml), F.lit("%j"), json_), F.lit("%r"), F.col("url")).alias("body")) for name, body in FORMATS.items()))
    site = F.concat(F.lit("https://"), F.col("host"), F.lit("/"))
    documents = rows.select("id", site.alias("base"), site.alias("site"), F.explode(bodies).alias("x")).select("id", "base", "site", "x.body")
    return sitemaps.listed(documents, "id", "base", "site").select("id", "format", "kind", "url", "reason")


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Each result as a page that links to itself, to a foreign language, a feed and another host: (id, reason, n, score)."""
    from raqim.functions import html

    rows = table(spark, d, "crawler_results").select("id", "url")
    page = F.concat(F.lit('<body><a href="'), F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit('">x</a><p><a href="/en/news">y<a href="/feed">z</a><a href="https://other.example/">o</a>'))
    fields = html.fields(rows.withColumn("html", page), "html", ("anchors",))
    links = sitemaps.page_links(fields, "id", "url", "url")
    return links.groupBy("id", F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(F.count("*").alias("n"))


_LINKS = f"""WITH {S.url_parts('crawler_results', 'url', 'id')}, j AS (SELECT *, bare AS site_bare, port AS site_port FROM parts), r AS (SELECT id, coalesce({S.reason()}, 'admitted') AS reason FROM j
  UNION ALL SELECT id, unnest(['non_arabic_language', 'administrative_or_feed_path', 'external_host']) FROM crawler_results) SELECT id, reason, count(*) AS n FROM r GROUP BY ALL"""


def robots_policies(spark: SparkSession, d: str) -> DataFrame:
    """Attempts read as fetches of a robots file: which statuses deny everything."""
    from raqim.plans.crawl import attempts

    rows = attempts(spark, d).select(F.col("id").alias("origin"), F.when(F.col("error").isNull(), F.col("http_status")).alias("status"), F.lit(None).cast("binary").alias("body"))
    return robots.policies(rows).select(F.col("origin").alias("id"), "deny_all")


def _safe_sql() -> str:
    return f"CASE WHEN {S.WEB} THEN scheme || '://' || host || {S.AT} || path || CASE WHEN query <> '' THEN '?[redacted]' ELSE '' END ELSE '' END"


def _page_sql() -> str:
    return f"CASE WHEN {S.WEB} THEN scheme || '://' || host || {S.AT} || path || CASE WHEN asked THEN '?' || query ELSE '' END ELSE '' END"


QUERIES: dict[str, tuple] = {
    "url_canonical": (_on("crawler_results", "id", urls.canonical_crawl, "canonical"), _sql("crawler_results", S.canonical_crawl(), "canonical")),
    "url_canonical_sorted": (_on("crawler_results", "id", urls.canonical_discovery, "canonical"), _sql("crawler_results", S.canonical_discovery(), "canonical")),
    "url_canonical_seed": (_on("crawler_sites", "id", urls.canonical_seed, "canonical"), _sql("crawler_sites", S.canonical_seed(), "canonical")),
    "url_sitemap_form": (_on("crawler_results", "id", urls.sitemap_form, "canonical"), _sql("crawler_results", S.sitemap_form(), "canonical")),
    "url_site_domain": (_on("crawler_results", "id", urls.site_domain, "domain"), _sql("crawler_results", "bare", "domain")),
    "url_page": (_on("crawler_results", "id", urls.page_url, "page"), _sql("crawler_results", _page_sql(), "page")),
    "url_safe": (_on("crawler_results", "id", urls.safe_url, "safe"), _sql("crawler_results", _safe_sql(), "safe")),
    "url_duplicates": (url_duplicates, f"WITH {S.url_parts('crawler_results', 'url', 'id')}, c AS (SELECT id, {S.canonical_discovery()} AS url FROM parts) SELECT url, count(*) AS n, min(id) AS first_id FROM c GROUP BY url HAVING count(*) > 1"),
    "page_admission": (page_admission, f"{_ADMISSION} SELECT id, site_id, CASE WHEN reason IS NULL THEN c ELSE '' END AS canonical, reason FROM final"),
    "admission_histogram": (admission_histogram, f"{_ADMISSION} SELECT site_id, coalesce(reason, 'admitted') AS reason, count(*) AS n FROM final GROUP BY ALL"),
    "admission_of_results": (
        admission_of_results,
        f"""WITH o AS (SELECT id + 1 AS id, url AS site FROM crawler_results), j AS (SELECT r.id, r.url, o.site FROM crawler_results r JOIN o USING (id)), {S.url_parts('j', 'url', 'id, site')},
          sp AS (SELECT *, lower(regexp_extract(regexp_extract({S.trim('site')}, {S.q(urls.AUTHORITY)}, 1), {S.q(urls.HOST)}, 1)) AS sh FROM parts), judged AS (SELECT *, regexp_replace(sh, '^www\\.', '') AS site_bare, '' AS site_port FROM sp)
          SELECT id, {S.reason()} AS reason FROM judged""",
    ),
    "sitemap_candidates": (sitemap_candidates, _candidates_sql(sitemaps.SITEMAP_PATHS)),
    "feed_candidates": (feed_candidates, _candidates_sql(sitemaps.FEED_PATHS)),
    "robots_rules": (robots_rules, "SELECT CAST(policy AS INTEGER) AS policy, allow, pattern FROM (VALUES (0, false, '/blog/'), (0, true, '/blog/qamar'), (0, false, '/*suq*$'), (1, false, '/p/'), (1, true, '/p/'), (1, false, '/news/*river')) t(policy, allow, pattern)"),
    "robots_allowed": (robots_allowed, _ROBOTS_SQL),
    "robots_policies": (
        robots_policies,
        """WITH a AS (SELECT id, CASE WHEN error IS NULL AND json_valid(metadata) THEN TRY_CAST(json_extract_string(CASE WHEN json_valid(metadata) THEN metadata END, '$.httpStatus') AS INTEGER) END AS s FROM crawler_attempts) SELECT id, s IS NULL OR s = 429 OR s >= 500 AS deny_all FROM a""",
    ),
    "sitemap_listed": (sitemap_listed, f"{_LISTED} SELECT map, format, CASE WHEN reason IS NULL THEN 'page' ELSE 'refused' END AS kind, CASE WHEN reason IS NULL THEN c ELSE '' END AS url, reason FROM l"),
    "sitemap_pages": (sitemap_pages, f"{_LISTED} SELECT DISTINCT map, 'page' AS kind, c AS url FROM l WHERE reason IS NULL"),
    "sitemap_rejections": (sitemap_rejections, f"{_LISTED} SELECT map, reason, count(*) AS n FROM l WHERE reason IS NOT NULL GROUP BY ALL"),
    "sitemap_formats": (
        sitemap_formats,
        f"""{_LISTED.replace("l AS (SELECT bare", "l AS (SELECT id, bare")}, f(format) AS (VALUES {", ".join(f"('{x}')" for x in FORMATS if x != "sitemapindex")})
          SELECT l.id, f.format, CASE WHEN reason IS NULL THEN 'page' ELSE 'refused' END AS kind, CASE WHEN reason IS NULL THEN c ELSE '' END AS url, reason FROM l CROSS JOIN f
          UNION ALL SELECT id, 'sitemapindex', 'sitemap', {S.sitemap_form()}, NULL FROM c""",
    ),
    "discovered_pages": (discovered_pages, f"{_RUNS} SELECT site_id, url FROM pages"),
    "discovery_runs": (discovery_runs, f"{_RUNS} {_RUNS_SQL}"),
    "page_links": (page_links, _LINKS),
    "seed_urls": (seed_urls, f"WITH {S.url_parts('crawler_sites', 'url', 'id')} SELECT DISTINCT {S.canonical_seed()} AS url FROM parts"),
    "url_tree": (url_tree, _TREE_SQL),
}

