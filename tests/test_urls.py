from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from raqim.functions import admission, urls


def run(spark, expression, rows, *columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{c} string" for c in columns))
    return [r.v for r in df.select("i", expression(*[F.col(c) for c in columns]).alias("v")).orderBy("i").collect()]


def test_canonical_forms(spark):
    rows = [("https://WWW.Example.COM:443/A/index.html?utm_source=x&keep=1#frag",), ("http://user:pw@a.org/x//",), ("https://a.org",), ("nonsense",), (None,), ("ftp://a.org/x",), ("https://a.org/?b=2&a=1&gclid=3",)]
    assert run(spark, urls.canonical_crawl, rows, "u") == ["https://example.com/A?keep=1", "http://a.org/x", "https://a.org/", "", "", "ftp://a.org/x", "https://a.org/?b=2&a=1"]
    assert run(spark, urls.canonical_discovery, rows, "u") == ["https://example.com/A?keep=1", "http://a.org/x", "https://a.org/", "", "", "", "https://a.org/?a=1&b=2"]
    assert run(spark, urls.canonical_seed, [("https://quran.com/",), ("https://www.a.org/index.php",)], "u") == ["https://quran.com/ar", "https://a.org/"]
    assert run(spark, urls.sitemap_form, [("http://www.a.org:80/map/index.html?utm_x=1&a=2#f",)], "u") == ["http://a.org/map/index.html?a=2&utm_x=1"]


def test_sitemap_addresses(spark):
    rows = [("https://a.org/x/map.xml", "https://www.a.org/"), ("https://b.org/map.xml", "https://a.org"), ("https://a.org/list", "https://a.org"), ("https://a.org/sitemap.gz", "https://a.org"), ("https://a.org:8443/sitemap", "https://a.org")]
    assert run(spark, urls.sitemap_url, rows, "u", "s") == ["https://a.org/x/map.xml", "", "", "https://a.org/sitemap.gz", ""]
    assert run(spark, lambda u, s: urls.sitemap_url(u, s, True), rows[2:3], "u", "s") == ["https://a.org/list"]


def test_relative(spark):
    rows = [("../b", "https://a.org/x/y/z"), ("?q=1", "https://a.org/x?z"), ("//c.org/d", "http://a.org"), ("/é t", "https://a.org/x"), ("#f", "https://a.org/x"), (None, "https://a.org"), ("./", "https://a.org/p/q")]
    assert run(spark, urls.resolve, rows, "u", "b") == ["https://a.org/x/b", "https://a.org/x?q=1", "http://c.org/d", "https://a.org/%C3%A9%20t", "https://a.org/x#f", "", "https://a.org/p/"]


def test_index_addresses(spark):
    assert run(spark, urls.site_domain, [("www.A.org/x",), ("HTTPS://b.org:1/",), ("",), (None,)], "u") == ["a.org", "b.org", "", ""]
    assert run(spark, urls.page_url, [("a.org/x#f",), ("https://www.a.org/x/?a",), ("ftp://y.z",), ("",)], "u") == ["https://a.org/x", "https://www.a.org/x/?a", "", ""]
    assert run(spark, urls.safe_url, [("https://a.org/x?secret=1#f",)], "u") == ["https://a.org/x?[redacted]"]
    rows = [(" 'https://a.org/x' ", "https://b.org"), ("mailto:x", "https://b.org"), ("/r?u=https://c.org/d", "https://b.org"), ("/feeds/posts", "https://b.org"), ("x", "https://b.org/y/")]
    assert run(spark, urls.clean_candidate, rows, "u", "b") == ["https://a.org/x", "", "https://c.org/d", "", "https://b.org/y/x"]
    assert run(spark, urls.icon_url, [(None, "https://a.org/x/y"), ("./favicon.ico?v=1", "https://a.org/x/y"), ("/i.png", "https://a.org/x")], "u", "b") == ["https://a.org/favicon.ico", "https://a.org/favicon.ico?v=1", "https://a.org/i.png"]
    assert run(spark, urls.is_social, [("www.youtube.com",), ("m.facebook.com",), ("notfacebook.com",)], "h") == [True, True, False]


def test_admission(spark):
    site = "https://www.a.org/"
    rows = [("/news/1", None), ("https://b.org/x", "external_host"), ("https://a.org:8080/", "different_port"), ("/x.pdf", "asset_file"), ("/admin/x", "administrative_or_feed_path"), ("/about-us", "noncontent_information_path"), ("/من-نحن", "noncontent_information_path"), ("/sitemap_x", "sitemap_or_feed_path"), ("/find/x", "search_results_path"), ("/en-us/x", "non_arabic_language"), ("/x/book-english", "non_arabic_language_suffix"), ("/x?lang=fr", "non_arabic_language_parameter"), ("/x?lang=ar-eg", None), ("javascript:x", "unsupported_scheme"), ("/%FF", "invalid_path_encoding"), ("/robots.txt", "robots_file")]
    got = run(spark, lambda u, s: admission.decision(u, s)["reason"], [(u, site) for u, _ in rows], "u", "s")
    assert got == [r for _, r in rows]
    assert run(spark, admission.is_page, [("/a?utm_x=1&b=2", site), ("https://quran.com/2", "https://quran.com"), ("https://quran.com/ar/translations/1", "https://quran.com")], "u", "s") == ["https://a.org/a?b=2", "https://quran.com/ar/2", ""]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.from_regex(r"https?://(www\.)?[a-z]{1,6}\.org(:\d{2,4})?(/[a-z.]{0,5}){0,4}(\?[a-z]=[a-z0-9%+]{0,4}(&utm_[a-z]=1)?)?", fullmatch=True), min_size=20, max_size=20))
def test_idempotent(spark, many):
    for f in (urls.canonical_crawl, urls.canonical_discovery, urls.canonical_seed, urls.sitemap_form):
        once = run(spark, f, [(u,) for u in many], "u")
        assert run(spark, f, [(u,) for u in once], "u") == once


def test_language_parameters_are_decoded(spark):
    rows = [("https://a.org/x?l%61ng=fr",), ("https://a.org/x?lang=%61r",), ("https://a.org/x?lang=&locale=de",), ("https://a.org/x?slang=fr",), ("https://a.org/x?lang=ar&lang=fr",)]
    df = spark.createDataFrame(rows, "u string")
    got = [r.r for r in df.select(admission.decision(F.col("u"), F.lit("https://a.org/"))["reason"].alias("r")).collect()]
    assert got == ["non_arabic_language_parameter", None, "non_arabic_language_parameter", None, None]
