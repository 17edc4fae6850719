"""Metadata and text of captured pages, from the raw fields of the HTML parser on as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raqim.functions import html, text, urls

DESCRIPTION, SNIPPET, SUMMARY = 250, 320, 500
REQUIRED = ("url", "title", "description", "icon_url", "keywords", "snippet")


def _or(a: Column, b: Column) -> Column:
    return F.coalesce(F.nullif(a, F.lit("")), b)


def light(pages: DataFrame, url: str = "url", document: str = "html") -> DataFrame:
    """The production extraction: url, title, description, snippet, icon_url, content_hash, quality, beside the other columns."""
    raw = html.fields(pages, document, ("title", "og_title", "description", "og_description", "icon", "light_text"))
    title = _or(text.strip_tags(F.col("title")), text.strip_tags(F.col("og_title")))
    description = F.substring(text.strip_tags(_or(F.col("description"), F.col("og_description"))), 1, DESCRIPTION)
    keep = [c for c in pages.columns if c not in (document,)]
    step = raw.select(*keep, title.alias("title__"), description.alias("description__"), F.col("light_text").alias("text__"), urls.icon_url(F.col("icon"), F.col(url)).alias("icon_url"))
    step = step.withColumn("snippet", text.summary(F.col("title__"), F.col("description__"), F.col("text__"), SNIPPET))
    step = step.withColumn("content_hash", F.sha2(F.concat_ws("\n", url, "title__", "description__", "snippet", "icon_url"), 256))
    good = (F.col("title__") != "") & (F.col("icon_url") != "") & (F.col("snippet") != "")
    final = step.withColumn("quality", F.when(good, "good").otherwise("thin_content")).withColumn("description", _or(F.col("description__"), F.substring("snippet", 1, DESCRIPTION)))
    return final.withColumn("title", F.col("title__")).drop("title__", "description__", "text__")


def compact(extracted: DataFrame, url: str = "url") -> DataFrame:
    """What the index stores: canonical URL, fields cut to 250 characters, no keywords."""
    canonical = urls.canonical_crawl(F.col(url))
    return extracted.select(
        _or(canonical, F.col(url)).alias("url"), text.collapse(F.col("title"), 250).alias("title"), text.collapse(F.col("description"), 250).alias("description"), text.collapse(F.col("icon_url"), 1000).alias("icon_url"),
        F.lit("").alias("keywords"), text.collapse(F.col("snippet"), 250).alias("snippet"), "quality", F.length(text.trim(F.col("snippet"))).alias("text_length"),
    )


def rich(pages: DataFrame, url: str = "url", document: str = "html", content_type: str = "content_type") -> DataFrame:
    """The library extraction: title, description, summary, search_snippet, text, quality, language, links by kind, hash."""
    raw = html.fields(pages, document, ("title", "og_title", "description", "og_description", "meta_keywords", "icon", "useful_text", "article_text", "content_anchors"))
    host = urls.bare_host(F.col(url))
    name = text.tidy(_or(text.tidy(F.col("title")), F.col("og_title")))
    named = F.when(name.rlike("(?i)^https?://"), F.concat(F.lit("موقع "), host)).otherwise(name)
    blog = urls.parts(F.col(url))["path"].rlike(r"/\d{4}/\d{2}/|^/p/")
    lines = F.filter(F.transform(F.split("article_text", r"\n+"), text.tidy), lambda x: (F.length(x) >= 25) & ~F.rlike(x, F.lit(text.NOISE)))
    step = raw.withColumn("title", named).withColumn("text", F.col("useful_text"))
    lead = text.collapse(F.array_join(F.slice(lines, 1, 3), " "))
    lead = F.when(F.startswith(F.lower(lead), F.lower("title")), F.regexp_replace(F.substr(lead, F.length("title") + 1), r"^\s*[-—:]?\s*", "")).otherwise(lead)
    step = step.withColumn("summary", text.summary(F.col("title"), F.lit(""), F.col("text"), SUMMARY))
    own = F.when(blog, text.trim(F.substring(lead, 1, SUMMARY))).otherwise(text.tidy(_or(F.col("description"), F.col("og_description"))))
    step = step.withColumn("description", _or(own, F.col("summary")))
    step = step.withColumn("search_snippet", text.search_snippet(F.col("title"), F.col("description"), F.col("summary"), F.col("text"), SNIPPET))
    step = step.withColumn("q", text.quality(F.col("title"), F.col("description"), F.col("text"), F.col(content_type)))
    found = F.transform("content_anchors", lambda a: F.struct(urls.clean_candidate(a["href"], F.col(url)).alias("url"), F.substring(text.tidy(a["text"]), 1, 200).alias("anchor_text")))
    kept = F.filter(found, lambda x: x["url"] != "")
    first = F.filter(kept, lambda x, i: F.array_position(F.transform(kept, lambda y: y["url"]), x["url"]) == i + 1)
    step = step.withColumn("found__", first)
    kind = lambda x: urls.let(urls.bare_host(x["url"]), lambda h: F.when(urls.is_social(h), "social").when(h == host, "internal").otherwise("external"))
    step = step.withColumn("links__", F.transform("found__", lambda x: F.struct(x["url"].alias("url"), x["anchor_text"].alias("anchor_text"), kind(x).alias("type"))))
    of = lambda t: F.transform(F.filter("links__", lambda x: x["type"] == t), lambda x: x["url"])
    keep = [c for c in pages.columns if c != document]
    return step.select(
        *keep, "title", "description", "summary", "search_snippet", urls.icon_url(F.col("icon"), F.col(url)).alias("icon_url"), "text", F.col("q.status").alias("quality"), F.col("q.language").alias("language"), "meta_keywords",
        F.slice("links__", 1, 100).alias("links"), of("internal").alias("internal_links"), of("external").alias("external_links"), of("social").alias("social_links"),
        F.sha2(F.concat_ws("\n", "title", "description", "summary", "search_snippet", "text"), 256).alias("content_hash"),
    )


def is_complete() -> Column:
    """No error, a status of success, HTML, good quality, some text, and all required fields but keywords."""
    fields = F.lit(True)
    for f in REQUIRED:
        if f != "keywords":
            fields = fields & (F.coalesce(F.col(f), F.lit("")) != "")
    return F.coalesce(F.col("error").isNull() & F.col("status").between(200, 399) & F.col("content_type").rlike("(?i)html") & (F.col("quality") == "good") & (F.col("text_length") >= 1) & fields, F.lit(False))


def needs_browser() -> Column:
    """An error status, no HTML or no text."""
    return (F.coalesce("status", F.lit(0)) >= 400) | ~F.coalesce(F.col("content_type"), F.lit("")).rlike("(?i)html") | (F.coalesce("text_length", F.lit(0)) < 1)


def error_code(error: Column, status: Column, content_type: Column, quality: Column) -> Column:
    return (
        F.when(error.isNotNull() & (error != ""), F.when(F.instr(error, "timeout") > 0, "timeout").otherwise("fetch_error"))
        .when(status == 404, "not_found").when(status == 403, "forbidden").when(status == 429, "rate_limited").when(status >= 400, F.concat(F.lit("http_"), status.cast("string")))
        .when(~F.coalesce(content_type, F.lit("")).rlike("(?i)html"), "not_html").when(quality.isNotNull() & (quality != "") & (quality != "good"), quality).otherwise("unknown")
    )


def review_reason(error: Column, status: Column, content_type: Column, quality: Column, text_length: Column, missing: Column, browser_error: Column | None = None) -> Column:
    """Why a page needs review; ``missing`` is the array of required fields that are empty, ``browser_error`` what a renderer reported."""
    failed = F.lit(False) if browser_error is None else F.coalesce(browser_error, F.lit("")) != ""
    return F.when(error.isNotNull() & (error != ""), F.when(F.instr(error, "timeout") > 0, "fetch_timeout").otherwise("fetch_error")).when(
        ~F.coalesce(status, F.lit(0)).between(200, 399), F.concat(F.lit("http_"), F.when(F.coalesce(status, F.lit(0)) == 0, "unknown").otherwise(status.cast("string")))
    ).when(~F.coalesce(content_type, F.lit("")).rlike("(?i)html"), "not_html").when(quality.isNotNull() & (quality != "") & (quality != "good"), quality).when(
        F.coalesce(text_length, F.lit(0)) < 1, "insufficient_extracted_text"
    ).when(F.size(missing) > 0, F.concat(F.lit("missing_"), F.array_join(missing, "_"))).when(failed, "browser_fallback_failed").otherwise("unknown")


def missing_fields() -> Column:
    """The required fields that are empty, in their order."""
    return F.filter(F.array(*(F.when(F.coalesce(F.col(f), F.lit("")) == "", F.lit(f)) for f in REQUIRED)), lambda x: x.isNotNull())


#: Columns of a fetch that its trace holds, with the most characters of a text.
TRACE = (("status", "http_status", 0), ("content_type", "content_type", 100), ("response_url", "response_url", 1000), ("fetch_method", "fetch_method", 0), ("duration_ms", "duration_ms", 0), ("fetch_attempts", "fetch_attempts", 0), ("page_attempt", "page_attempt", 0), ("browser_error", "browser_error", 0), ("http_duration_ms", "http_duration_ms", 0))


def trace(pages: DataFrame) -> Column:
    """How a page was fetched, of the columns that are there; numbers that are missing are 0."""
    out = []
    for c, name, most in TRACE:
        if c in pages.columns:
            number = pages.schema[c].dataType.typeName() in ("integer", "long", "short", "double")
            value = F.coalesce(F.col(c), F.lit(0)) if number else F.coalesce(F.col(c).cast("string"), F.lit(""))
            out.append((F.substring(value, 1, most) if most else value).alias(name))
    return F.struct(*out)


def diagnosed(pages: DataFrame) -> DataFrame:
    """``pages`` (a fetch with its extracted fields, quality, text and error) with ``diagnosis``: reason, missing fields, quality, text length, an excerpt of 300
    characters, the observed fields (320 characters of a snippet, 500 of others), the error's first 500 characters and the trace."""
    error = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    browser = F.col("browser_error") if "browser_error" in pages.columns else None
    length = F.length(text.trim(F.coalesce(F.col("text"), F.lit(""))))
    observed = F.struct(*(F.substring(F.coalesce(F.col(f), F.lit("")), 1, SNIPPET if f == "snippet" else SUMMARY).alias(f) for f in REQUIRED))
    return pages.withColumn("missing__", missing_fields()).withColumn("length__", length).withColumn(
        "diagnosis",
        F.struct(
            review_reason(error, F.col("status"), F.col("content_type"), F.col("quality"), F.col("length__"), F.col("missing__"), browser).alias("reason"), F.col("missing__").alias("missing_fields"),
            F.coalesce(F.nullif("quality", F.lit("")), F.lit("unknown")).alias("quality"), F.col("length__").alias("text_length"), text.collapse(F.col("text"), 300).alias("excerpt"), observed.alias("observed"),
            F.substring(error, 1, SUMMARY).alias("error"), trace(pages).alias("trace"),
        ),
    ).drop("missing__", "length__")
