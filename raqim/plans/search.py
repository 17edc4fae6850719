"""Queries over extracted text, classification and the search store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from raqim.functions import text, urls
from raqim.operators import classify, extract, ingest, state
from raqim.plans import sqltext as S
from raqim.session import checkpointed, spread, table


def _results(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crawler_results")


def text_searchable(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d).select("id", text.searchable(F.col("title")).alias("title"), text.searchable(F.col("snippet")).alias("snippet"))


def text_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d).select("id", text.collapse(F.col("snippet"), 250).alias("collapsed"), text.tidy(F.col("snippet")).alias("tidied"), text.strip_tags(F.col("description")).alias("stripped"))


def language_mix(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.letters(F.col("text"), "ar").cast("long").alias("arabic"), text.letters(F.col("text"), "latin").cast("long").alias("latin"))


def quality_status(spark: SparkSession, d: str) -> DataFrame:
    rows = _results(spark, d).select("id", text.quality(F.col("title"), F.col("description"), F.col("snippet"), F.lit("text/html")).alias("q"))
    return rows.select("id", F.col("q.status").alias("status"), F.col("q.language").alias("language"))


def summaries(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d).select("id", text.summary(F.col("title"), F.col("description"), F.col("snippet")).alias("summary"))


def search_snippets(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d).select("id", text.search_snippet(text.collapse(F.col("title")), text.collapse(F.col("description")), F.lit(""), F.lit("")).alias("snippet"))


_BODY = S.collapse(S.sub(S.strip_tags("snippet"), text.REDIRECT))
_SUMMARY = f"""WITH b AS (SELECT id, title, description, {_BODY} AS body FROM crawler_results), w AS (SELECT *, CASE WHEN title IS NOT NULL AND title <> '' THEN {S.collapse("replace(body, title, ' ')")} ELSE body END AS rest FROM b)
  SELECT id, {S.trim("substr(coalesce(nullif(rest, ''), nullif(coalesce(description, ''), ''), coalesce(title, '')), 1, 320)")} AS summary FROM w"""
_SNIPPET = f"""WITH c AS (SELECT id, {S.collapse('title')} AS t, {S.collapse('description')} AS d FROM crawler_results)
  SELECT id, substr(CASE WHEN t <> '' AND NOT starts_with(lower(d), lower(t)) THEN t || ' — ' || d ELSE d END, 1, 320) AS snippet FROM c"""


def _keywords(spark: SparkSession, d: str) -> DataFrame:
    """(site category, keyword, n) over the keywords of all results."""
    host = urls.bare_host(F.col("url"))
    sites = table(spark, d, "crawler_sites").select(host.alias("host"), "category").dropDuplicates(["host"])
    results = _results(spark, d).filter("keywords <> ''").select(host.alias("host"), "keywords").join(sites, "host")
    each = results.select("category", F.explode(F.split("keywords", r"[,،;؛]")).alias("k")).groupBy("category", "k").agg(F.count("*").alias("n"))  # so that each is brought to its searchable form once
    return each.select("category", text.searchable(F.col("k")).alias("keyword"), "n").filter(F.length("keyword") >= 2).groupBy("category", "keyword").agg(F.sum("n").alias("n"))


#: A category of the corpus has a keyword at its top level if the length is a multiple of this, else in a subcategory of that length.
PARTS = 8


def corpus_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """All keywords of the results of each site category, told apart into a top level and seven subcategories by their length: a taxonomy
    of the corpus itself."""
    part = F.length("keyword") % PARTS
    return _keywords(spark, d).select("category", F.when(part > 0, F.concat_ws("_", "category", part.cast("string"))).alias("subcategory"), "keyword")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spread(_results(spark, d)).select("id", "title", "description", F.col("snippet").alias("body"))


def keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    found = classify.hits(_docs(spark, d), checkpointed(corpus_taxonomy(spark, d)))
    return found.select("id", "category", "subcategory", "keyword", "title_hits", "description_hits", F.col("text_hits").cast("long").alias("text_hits"), F.col("points").cast("long").alias("points"))


def category_scores(spark: SparkSession, d: str) -> DataFrame:
    found = classify.hits(_docs(spark, d), checkpointed(corpus_taxonomy(spark, d)))
    return classify.category_scores(found).select("id", "category", F.col("score").cast("long").alias("score"))


def classified(spark: SparkSession, d: str) -> DataFrame:
    rows = classify.classify(_docs(spark, d), checkpointed(corpus_taxonomy(spark, d)))
    return rows.select("id", "category", F.col("score").cast("long").alias("score"), F.col("confidence").cast("double").alias("confidence"))


def matched_keywords(spark: SparkSession, d: str) -> DataFrame:
    """The keywords that decide each result's category, and those of its own that its text confirms: (id, category, subcategories, keywords)."""
    docs = spread(_results(spark, d)).select("id", "title", "description", F.col("snippet").alias("body"), F.col("keywords").alias("page_keywords"))
    rows = classify.classify(docs, checkpointed(corpus_taxonomy(spark, d)))
    return rows.select("id", "category", F.array_join("subcategories", ";").alias("subcategories"), F.array_join("keywords", ";").alias("keywords"), F.size("reasons").cast("long").alias("reasons"), F.coalesce(F.size("candidates"), F.lit(0)).cast("long").alias("candidates"))


_HOST = f"regexp_replace(lower(regexp_extract(regexp_extract({S.trim('url')}, {S.q(urls.AUTHORITY)}, 1), {S.q(urls.HOST)}, 1)), '^www\\.', '')"
_GRAMS = "list_transform(list_filter(string_split(regexp_replace({x}, '[^\\p{{L}}\\p{{N}} ]+', chr(10), 'g'), chr(10)), lambda r: trim(r) <> ''), lambda r: list_filter(string_split(r, ' '), lambda w: w <> ''))"
_FIELDS = "SELECT id, 't' AS f, t AS x FROM n UNION ALL SELECT id, 'd', d FROM n UNION ALL SELECT id, 'a', concat_ws(' ', t, d, b) FROM n"
_HITS = f"""ks AS (SELECT {_HOST} AS host, {S.searchable('k')} AS keyword FROM (SELECT url, unnest(regexp_split_to_array(keywords, '[,،;؛]')) AS k FROM crawler_results) WHERE k IS NOT NULL),
  st AS (SELECT host, any_value(category) AS category FROM (SELECT {_HOST} AS host, category FROM crawler_sites) GROUP BY host),
  rk AS (SELECT DISTINCT category, keyword FROM ks JOIN st USING (host) WHERE length(keyword) >= 2),
  tx AS (SELECT category, CASE WHEN length(keyword) % {PARTS} > 0 THEN category || '_' || (length(keyword) % {PARTS}) END AS subcategory, keyword FROM rk),
  vs AS (SELECT *, unnest(CASE WHEN regexp_matches(keyword, '^[\\x{{0600}}-\\x{{06FF}}\\s]+$') THEN list_distinct([keyword, {', '.join(f"'{p}' || keyword" for p in classify.PREFIXES)}]) ELSE [keyword] END) AS variant FROM tx),
  n AS (SELECT id, {S.searchable('title')} AS t, {S.searchable('description')} AS d, {S.searchable('snippet')} AS b FROM crawler_results),
  fs AS ({_FIELDS}),
  ws AS (SELECT id, f, unnest({_GRAMS.format(x='x')}) AS w FROM fs),
  ls AS (SELECT id, f, w, unnest(range(1, (SELECT max(len(string_split(keyword, ' '))) + 1 FROM tx))) AS k FROM ws),
  gs AS (SELECT id, f, array_to_string(w[i:i + k - 1], ' ') AS variant FROM (SELECT id, f, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM ls WHERE len(w) >= k)),
  hs AS (SELECT id, category, subcategory, keyword, count(*) FILTER (f = 't') AS title_hits, count(*) FILTER (f = 'd') AS description_hits, least(count(*) FILTER (f = 'a'), 2) AS text_hits FROM gs JOIN vs USING (variant) GROUP BY ALL),
  h AS (SELECT *, title_hits * 5 + description_hits * 3 + text_hits AS points FROM hs)"""
_SCORES = f"""{_HITS}, sb AS (SELECT id, category, subcategory, sum(points) AS s FROM h WHERE subcategory IS NOT NULL GROUP BY ALL),
  s5 AS (SELECT * FROM sb QUALIFY row_number() OVER (PARTITION BY id, category ORDER BY s DESC, subcategory) <= 5),
  sc AS (SELECT id, category, CAST(sum(s) AS BIGINT) AS score FROM (SELECT id, category, points AS s FROM h WHERE subcategory IS NULL UNION ALL SELECT id, category, s FROM s5) GROUP BY id, category)"""


def reviewed(spark: SparkSession, d: str) -> DataFrame:
    """Every result diagnosed as a page that was fetched with success: (id, reason, missing, quality, text_length, excerpt)."""
    rows = _results(spark, d).select("id", "url", "title", "description", "icon_url", "keywords", "snippet", F.col("snippet").alias("text"), F.lit(200).alias("status"), F.lit("text/html").alias("content_type"))
    rows = rows.withColumn("quality", text.quality(F.col("title"), F.col("description"), F.col("snippet"), F.col("content_type"))["status"])
    x = F.col("diagnosis")
    return extract.diagnosed(rows).select("id", x["reason"].alias("reason"), F.array_join(x["missing_fields"], ",").alias("missing"), x["quality"].alias("quality"), x["text_length"].cast("long").alias("text_length"), x["excerpt"].alias("excerpt"))


_REVIEWED = f"""WITH c AS (SELECT *, coalesce(title, '') AS t, coalesce(description, '') AS de, coalesce(snippet, '') AS x FROM crawler_results),
  q AS (SELECT *, CASE WHEN t = '' AND de = '' AND length(x) < 1000 THEN 'not_indexable_api' WHEN regexp_matches(concat_ws(' ', t, de, x), {S.q(text.CHALLENGE)}) THEN 'blocked_challenge' WHEN t <> '' AND length(x) < 20 THEN 'dynamic_content' WHEN length(x) < 300 AND de = '' THEN 'thin_content' ELSE 'good' END AS quality,
    length({S.trim('x')}) AS text_length, array_to_string(list_filter([{', '.join(f"CASE WHEN coalesce({c}, '') = '' THEN '{c}' END" for c in extract.REQUIRED)}], lambda m: m IS NOT NULL), ',') AS missing FROM c)
  SELECT id, CASE WHEN quality <> 'good' THEN quality WHEN text_length < 1 THEN 'insufficient_extracted_text' WHEN missing <> '' THEN 'missing_' || replace(missing, ',', '_') ELSE 'unknown' END AS reason, missing, quality, text_length, {S.collapse('snippet', 300)} AS excerpt FROM q"""


_PREFIXED = "'" + "','".join(classify.PREFIXES) + "'"
_MATCHED = f"""WITH {_SCORES}, rs AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, category) AS r, count(*) OVER (PARTITION BY id) AS n FROM sc), b AS (SELECT id, category, least(n, 5) AS candidates FROM rs WHERE r = 1),
  bs AS (SELECT id, category, list(subcategory ORDER BY s DESC, subcategory) AS subs FROM s5 JOIN b USING (id, category) GROUP BY id, category),
  own AS (SELECT h.id, keyword, max(points) AS points, FROM h JOIN b USING (id, category) LEFT JOIN bs USING (id, category) WHERE h.subcategory IS NULL OR list_contains(bs.subs, h.subcategory) GROUP BY h.id, keyword),
  mk AS (SELECT id, list(keyword ORDER BY points DESC, keyword)[1:12] AS ks FROM own GROUP BY id),
  rz AS (SELECT h.id, count(*) AS reasons FROM h JOIN b USING (id, category) WHERE h.subcategory IS NULL GROUP BY h.id),
  vi AS (SELECT id, ' ' || regexp_replace(concat_ws(' ', t, d, b), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') || ' ' AS v FROM n),
  pk AS (SELECT id, unnest(string_split_regex(keywords, '[,;|]')) AS k, unnest(range(0, len(string_split_regex(keywords, '[,;|]')))) AS pos FROM crawler_results WHERE keywords IS NOT NULL),
  pt AS (SELECT id, pos, trim(k) AS keyword, {S.searchable('k')} AS term FROM pk WHERE trim(k) <> ''),
  pp0 AS (SELECT *, regexp_replace(term, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g') AS w FROM pt WHERE length(term) >= 3),
  cf AS (SELECT id, pos, keyword, term FROM pp0 JOIN vi USING (id) WHERE contains(v, ' ' || w || ' ') OR (regexp_matches(w, '^[\\x{{0600}}-\\x{{06FF}}\\s]+$') AND len(list_filter([{_PREFIXED}], lambda p: contains(v, ' ' || p || w || ' '))) > 0)),
  nw AS (SELECT c.id, c.pos, c.keyword FROM (SELECT * FROM cf QUALIFY row_number() OVER (PARTITION BY id, term ORDER BY pos) = 1) c LEFT JOIN mk USING (id) WHERE NOT coalesce(list_contains(mk.ks, c.term), false)),
  nl AS (SELECT id, list(keyword ORDER BY pos) AS ns FROM nw GROUP BY id)
  SELECT c.id, coalesce(b.category, 'other') AS category, coalesce(array_to_string(bs.subs, ';'), '') AS subcategories, array_to_string(list_concat(coalesce(mk.ks, []), coalesce(nl.ns, [])[1:16 - len(coalesce(mk.ks, []))]), ';') AS keywords,
  coalesce(rz.reasons, 0) AS reasons, coalesce(b.candidates, 0) AS candidates FROM crawler_results c LEFT JOIN b USING (id) LEFT JOIN bs ON bs.id = c.id LEFT JOIN mk ON mk.id = c.id LEFT JOIN nl ON nl.id = c.id LEFT JOIN rz ON rz.id = c.id"""


def light_extract(spark: SparkSession, d: str) -> DataFrame:
    """The results written as HTML pages, and read back."""
    escape = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    page = F.concat(F.lit("<!doctype html><html><head><title>"), escape(F.col("title")), F.lit('</title><meta name="description" content="'), escape(F.col("description")), F.lit('"></head><body><nav><a href="/">x</a></nav><article><p>'), escape(F.col("snippet")), F.lit("</article><script>var a='<p>no';</script></body></html>"))
    pages = spread(_results(spark, d)).select("id", "url", page.alias("html"))
    return extract.light(pages).select("id", "title", "snippet")


_TITLE = S.strip_tags("title")
_LIGHT = f"""WITH c AS (SELECT id, {_TITLE} AS title, substr({S.strip_tags('description')}, 1, 250) AS d, {S.collapse(S.sub(S.strip_tags('snippet'), text.REDIRECT))} AS body0, {S.strip_tags('snippet')} AS s0 FROM crawler_results),
  b AS (SELECT *, CASE WHEN length(s0) >= 2 THEN body0 ELSE body0 END AS body FROM c), w AS (SELECT *, CASE WHEN title <> '' THEN {S.collapse("replace(body, title, ' ')")} ELSE body END AS rest FROM b)
  SELECT id, title, {S.trim("substr(coalesce(nullif(rest, ''), nullif(d, ''), title), 1, 320)")} AS snippet FROM w"""


def ingest_rows(spark: SparkSession, d: str) -> DataFrame:
    return ingest.rows(spread(_results(spark, d)).select("id", "url", "title", "description", "icon_url", "keywords", "snippet")).select("id", "url", "title", "search_text", "valid")


def _ingested(spark: SparkSession, d: str) -> DataFrame:
    return ingest.rows(spread(_results(spark, d)).select("id", urls.canonical_discovery(F.col("url")).alias("url"), "title", "description", "icon_url", "keywords", "snippet"))


def display_pages(spark: SparkSession, d: str) -> DataFrame:
    """The display table after all results came in by id: the first of a page stays."""
    return ingest.display(_ingested(spark, d), "id")


def search_texts(spark: SparkSession, d: str) -> DataFrame:
    """The text table after all results came in by id: the last of a page replaces those before."""
    return ingest.search_texts(_ingested(spark, d), "id")


def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    return ingest.inverted(search_texts(spark, d)).select("term", "url", "tf", F.array_join(F.transform("positions", lambda x: x.cast("string")), ",").alias("positions"))


def term_counts(spark: SparkSession, d: str) -> DataFrame:
    """(term, documents, occurrences) of the text table, without building positions."""
    each = search_texts(spark, d).select("url", F.explode(ingest.terms(F.col("search_text"))).alias("term"))
    return each.groupBy("term", "url").agg(F.count("*").alias("tf")).groupBy("term").agg(F.count("*").alias("documents"), F.sum("tf").alias("occurrences"))


_CLEAN = lambda c: S.collapse(c, 20000)
_ROWS = """x AS (SELECT id, page AS url, {t} AS title, {d} AS description, {i} AS icon_url, concat_ws(' ', nullif({t}, ''), nullif({d}, ''), nullif({k}, ''), nullif({s}, ''), nullif(bare, '')) AS st FROM pp),
  rr AS (SELECT * EXCLUDE (st), {st} AS search_text FROM x)""".format(t=_CLEAN("title"), d=_CLEAN("description"), i=_CLEAN("icon_url"), k=_CLEAN("keywords"), s=_CLEAN("snippet"), st=_CLEAN("st"))
_PAGE = f"CASE WHEN {S.WEB} THEN scheme || '://' || host || {S.AT} || path || CASE WHEN asked THEN '?' || query ELSE '' END ELSE '' END"
_COLUMNS = "id, title, description, icon_url, keywords, snippet"
_INGEST = f"{S.url_parts('crawler_results', 'url', _COLUMNS)}, pp AS (SELECT *, {_PAGE} AS page FROM parts), {_ROWS}"
_CANON = f"c0 AS (WITH {S.url_parts('crawler_results', 'url', _COLUMNS)} SELECT {_COLUMNS}, {S.canonical_discovery()} AS url FROM parts), {S.url_parts('c0', 'url', _COLUMNS)}, pp AS (SELECT *, {_PAGE} AS page FROM parts), {_ROWS}, ok AS (SELECT * FROM rr WHERE url <> '' AND search_text <> '')"
_TEXTS = f"{_CANON}, tt AS (SELECT url, search_text FROM ok QUALIFY row_number() OVER (PARTITION BY url ORDER BY id DESC) = 1)"
_FOLD = f"translate(lower({S.sub('search_text', text.DIACRITICS)}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy')"
_TERMS = f"{_TEXTS}, tl AS (SELECT url, list_filter(regexp_split_to_array({_FOLD}, '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS ts FROM tt), te AS (SELECT url, unnest(ts) AS term, unnest(range(0, len(ts))) AS pos FROM tl)"


def upserted(spark: SparkSession, d: str) -> DataFrame:
    """The results with the later half of the crawl merged into the earlier one by canonical URL."""
    rows = _results(spark, d).select("id", urls.canonical_discovery(F.col("url")).alias("url"), "title", "snippet", "created_at", "updated_at")
    middle = rows.agg(F.expr("cast(avg(id) as bigint)").alias("m")).first()["m"] or 0
    first = Window.partitionBy("url").orderBy("id")
    old = rows.filter(F.col("id") <= middle).withColumn("r", F.row_number().over(first)).filter("r = 1").drop("r")
    return state.upsert(old, rows.filter(F.col("id") > middle), "url")


_UPSERT = f"""WITH {S.url_parts('crawler_results', 'url', 'id, title, snippet, created_at, updated_at')}, c AS (SELECT id, {S.canonical_discovery()} AS url, title, snippet, created_at, updated_at FROM parts), m AS (SELECT CAST(floor(avg(id)) AS BIGINT) AS m FROM c),
  o AS (SELECT c.* FROM c, m WHERE id <= m QUALIFY row_number() OVER (PARTITION BY url ORDER BY id) = 1), n AS (SELECT c.* FROM c, m WHERE id > m QUALIFY row_number() OVER (PARTITION BY url ORDER BY updated_at DESC NULLS LAST, id DESC) = 1)
  SELECT coalesce(o.id, n.id) AS id, coalesce(n.url, o.url) AS url, CASE WHEN n.url IS NOT NULL THEN n.title ELSE o.title END AS title, CASE WHEN n.url IS NOT NULL THEN n.snippet ELSE o.snippet END AS snippet, coalesce(o.created_at, n.created_at) AS created_at, CASE WHEN n.url IS NOT NULL THEN n.updated_at ELSE o.updated_at END AS updated_at
  FROM o FULL OUTER JOIN n ON o.url = n.url"""

QUERIES: dict[str, tuple] = {
    "text_searchable": (text_searchable, f"SELECT id, {S.searchable('title')} AS title, {S.searchable('snippet')} AS snippet FROM crawler_results"),
    "text_cleaned": (text_cleaned, f"SELECT id, {S.collapse('snippet', 250)} AS collapsed, {S.tidy('snippet')} AS tidied, {S.strip_tags('description')} AS stripped FROM crawler_results"),
    "language_mix": (language_mix, "SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^\\x{0600}-\\x{06FF}]', '', 'g')) AS arabic, length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS latin FROM documents"),
    "quality_status": (
        quality_status,
        f"""WITH c AS (SELECT id, coalesce(title, '') AS t, coalesce(description, '') AS d, coalesce(snippet, '') AS x, concat_ws(' ', coalesce(title, ''), coalesce(description, ''), coalesce(snippet, '')) AS b FROM crawler_results),
          n AS (SELECT *, length(regexp_replace(b, '[^\\x{{0600}}-\\x{{06FF}}]', '', 'g')) AS ar, length(regexp_replace(b, '[^A-Za-z]', '', 'g')) AS la FROM c)
          SELECT id, CASE WHEN t = '' AND d = '' AND length(x) < 1000 THEN 'not_indexable_api' WHEN regexp_matches(b, {S.q(text.CHALLENGE)}) THEN 'blocked_challenge' WHEN t <> '' AND length(x) < 20 THEN 'dynamic_content' WHEN length(x) < 300 AND d = '' THEN 'thin_content' ELSE 'good' END AS status,
          CASE WHEN ar > la THEN 'ar' WHEN la > 0 THEN 'latin' ELSE 'unknown' END AS language FROM n""",
    ),
    "summaries": (summaries, _SUMMARY),
    "search_snippets": (search_snippets, _SNIPPET),
    "keyword_hits": (keyword_hits, f"WITH {_HITS} SELECT id, category, subcategory, keyword, title_hits, description_hits, text_hits, points FROM h"),
    "category_scores": (category_scores, f"WITH {_SCORES} SELECT id, category, score FROM sc"),
    "classified": (
        classified,
        f"""WITH {_SCORES}, rs AS (SELECT *, row_number() OVER w AS r, lead(score) OVER w AS nx FROM sc WINDOW w AS (PARTITION BY id ORDER BY score DESC, category)), b AS (SELECT * FROM rs WHERE r = 1)
          SELECT c.id, coalesce(b.category, 'other') AS category, coalesce(b.score, 0) AS score, CASE WHEN b.score IS NULL THEN 0.0 ELSE round(greatest(least((b.score - coalesce(b.nx, 0) + least(b.score, 10)) / 20.0, 0.99), 0.05), 3) END::DOUBLE AS confidence FROM crawler_results c LEFT JOIN b USING (id)""",
    ),
    "matched_keywords": (matched_keywords, _MATCHED),
    "reviewed": (reviewed, _REVIEWED),
    "light_extract": (light_extract, _LIGHT),
    "ingest_rows": (ingest_rows, f"WITH {_INGEST} SELECT id, url, title, search_text, url <> '' AND search_text <> '' AS valid FROM rr"),
    "display_pages": (display_pages, f"WITH {_CANON} SELECT url, title, description, icon_url FROM ok QUALIFY row_number() OVER (PARTITION BY url ORDER BY id) = 1"),
    "search_texts": (search_texts, f"WITH {_TEXTS} SELECT url, search_text FROM tt"),
    "inverted_index": (inverted_index, f"WITH {_TERMS} SELECT term, url, count(*) AS tf, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions FROM te GROUP BY term, url"),
    "term_counts": (term_counts, f"WITH {_TERMS}, tf AS (SELECT term, url, count(*) AS n FROM te GROUP BY ALL) SELECT term, count(*) AS documents, CAST(sum(n) AS BIGINT) AS occurrences FROM tf GROUP BY term"),
    "upserted": (upserted, _UPSERT),
}
