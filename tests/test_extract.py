import gzip

from pyspark.sql import functions as F

from raqim.functions import html
from raqim.operators import extract
from raqim.sources import seeds, sitemaps

PAGE = """<!doctype html><html><head><title>A &amp; B</title><meta name=Description content="What  it says"><link rel="shortcut icon" href="favicon.ico"><link rel="alternate" hreflang="ar-eg" href="/ar/x">
<link rel=sitemap href="/maps/own"></head><body><nav><a href="/nav">menu</a></nav><article><h1>Head</h1><p>One paragraph<p>Two <b>bold<br>text</p><ul><li>a1<li>b2</ul><a href="/news/1">News</a> <a href="https://x.com/y">X</a></article><script>var p="<p>no";</script><footer>foot</footer></body></html>"""


def pages(spark, *docs):
    return spark.createDataFrame([(i, "https://www.a.org/2024/05/post", d, "text/html", None, 200) for i, d in enumerate(docs)], "id int, url string, html string, content_type string, error string, status int")


def test_tree():
    root = html.parse(PAGE)
    assert [n.text() for n in root.walk() if n.name == "li"] == ["a1", "b2"]
    assert html.light_text(root) == "Head\nOne paragraph\nTwo boldtext\na1\nb2"
    assert [a["href"] for a in html.anchors(root)] == ["/nav", "/news/1", "https://x.com/y"]
    assert [a["href"] for a in html.anchors(root, True)] == ["/news/1", "https://x.com/y"]
    assert html.light_text(html.parse(None)) == "" and html.light_text(html.parse("just text")) == "just text"


def test_light(spark):
    df = extract.light(pages(spark, PAGE, "", None))
    r = {x.id: x for x in df.collect()}
    assert (r[0].title, r[0].description, r[0].icon_url, r[0].quality) == ("A & B", "What it says", "https://www.a.org/favicon.ico", "good")
    assert r[1].quality == "thin_content" and r[2].snippet == ""
    done = extract.compact(df.withColumn("url", F.col("url"))).collect()
    assert done[0].url == "https://a.org/2024/05/post" and done[0].keywords == ""
    ready = extract.compact(df).withColumn("error", F.lit(None).cast("string")).withColumn("status", F.lit(200)).withColumn("content_type", F.lit("text/html")).withColumn("ok", extract.is_complete())
    assert [x.ok for x in ready.collect()] == [True, False, False]


def test_rich(spark):
    r = extract.rich(pages(spark, PAGE)).first()
    assert r.internal_links == ["https://www.a.org/news/1"] and r.social_links == ["https://x.com/y"] and r.language == "latin"
    assert r.text.startswith("HeadOne paragraph") and r.search_snippet.startswith("A & B — ")


def test_codes(spark):
    rows = [("browser_timeout", 0, "", "timeout", "fetch_timeout"), ("x", 0, "", "fetch_error", "fetch_error"), (None, 404, "text/html", "not_found", "http_404"), (None, 500, "text/html", "http_500", "http_500"), (None, 200, "image/png", "not_html", "not_html"), (None, 200, "text/html", "unknown", "missing_title_keywords"), (None, None, None, "not_html", "http_unknown")]
    df = spark.createDataFrame(rows, "e string, s int, c string, code string, reason string")
    got = df.select("code", "reason", extract.error_code(F.col("e"), F.col("s"), F.col("c"), F.lit("good")).alias("a"), extract.review_reason(F.col("e"), F.col("s"), F.col("c"), F.lit("good"), F.lit(9), F.array(F.lit("title"), F.lit("keywords"))).alias("b")).collect()
    assert all(r.code == r.a and r.reason == r.b for r in got)


def test_sitemap_formats():
    index = '<?xml version="1.0"?><sitemapindex><sitemap><loc>https://a.org/1.xml</loc></sitemap><sitemap><loc>https://a.org/1.xml</loc></sitemap></sitemapindex>'
    assert sitemaps.entries(index) == ("sitemapindex", [("sitemap", "https://a.org/1.xml")] * 2)
    urlset = '<ns:urlset><ns:url><ns:loc>https://a.org/x?a=1&amp;b=2</ns:loc></ns:url><url><loc>https://a.org/en</loc><xhtml:link rel="alternate" hreflang="ar" href="https://a.org/ar"/></url></ns:urlset>'
    assert sitemaps.entries(gzip.compress(urlset.encode())) == ("urlset", [("any", "https://a.org/x?a=1&b=2"), ("any", "https://a.org/ar")])
    assert sitemaps.entries("<rss><channel><item><link>https://a.org/r</link></item></channel></rss>") == ("rss", [("any", "https://a.org/r")])
    assert sitemaps.entries('<feed><entry><link href="https://a.org/f"/></entry></feed>')[1] == [("any", "https://a.org/f")]
    assert sitemaps.entries('{"sitemaps": [{"loc": "/s"}], "urls": ["/p", {"url": "/q", "n": 1}]}') == ("json", [("sitemap", "/s"), ("any", "/p"), ("any", "/q")])
    assert sitemaps.entries("https://a.org/1\n\nhttps://a.org/2\n")[0] == "url-list"
    assert sitemaps.entries("<html><body>x")[0] == "" and sitemaps.entries(None)[0] == "" and sitemaps.entries("plain")[0] == ""


def test_listed(spark):
    body = "<urlset>" + "".join(f"<url><loc>{u}</loc></url>" for u in ("https://a.org/x", "https://a.org/x", "https://b.org/y", "https://a.org/more.xml", "https://a.org/a.pdf")) + "</urlset>"
    df = spark.createDataFrame([(1, "https://a.org/sitemap.xml", "https://a.org/", body), (2, "https://a.org/s", "https://a.org/", "no")], "id int, base string, site string, body string")
    rows = sitemaps.listed(df, "id", "base", "site")
    kinds = [(r.kind, r.url, r.reason) for r in rows.filter("id = 1").orderBy("pos").collect()]
    assert kinds == [("page", "https://a.org/x", None)] * 2 + [("refused", "", "external_host"), ("sitemap", "https://a.org/more.xml", None), ("refused", "", "asset_file")]
    assert sitemaps.first_seen(rows, "id").count() == 2 and {(r.reason, r.n) for r in sitemaps.rejections(rows, "id").collect()} == {("external_host", 1), ("asset_file", 1)}
    assert rows.filter("id = 2").first().pos is None


def test_links_of_pages(spark):
    f = html.fields(pages(spark, PAGE).withColumn("site", F.lit("https://a.org/")))
    links = {r.url: r.score for r in sitemaps.page_links(f, "id", "url", "site").collect() if r.url}
    assert links["https://a.org/news/1"] == 5
    assert [r.url for r in sitemaps.arabic_alternates(f, "id", "url", "site").collect()] == ["https://a.org/ar/x"]
    assert [r.url for r in sitemaps.declared(f, "id", "url").collect()] == ["https://a.org/maps/own"]
    assert f.select(sitemaps.should_hydrate(F.lit("<div id='app'>"), F.col("anchors"), F.col("text_length")).alias("h")).first().h


def test_seeds_and_rendering(spark):
    lines = spark.createDataFrame([("https://www.a.org/  # first",), ("# no",), ("",), ("https://a.org",), ("bad",)], "value string")
    assert [r.url for r in seeds.seeds(lines).collect()] == ["https://a.org/"]
    rows = spark.createDataFrame([("h", "i", "d", False), ("h", "i", "d", True), ("h", "", "d", True), ("h", None, None, True), (None, None, None, True)], "html string, interactive string, dumped string, should_hydrate boolean")
    assert [(r.method, r.document) for r in seeds.rendered(rows).collect()] == [("http", "h"), ("browser_interactive", "h\ni"), ("browser_dump_dom", "h\nd"), ("http_only", "h"), ("unavailable", "")]


def test_broken_and_nested_markup():
    e = sitemaps.entries
    assert e("<urlset><url><loc>/a</loc></url><url><loc>/b</loc>")[1] == [("any", "/a")]
    assert e('<sm:urlset><sm:url><sm:loc> /a&#38;b </sm:loc><x:link hreflang="AR" href=\'/ar?a=1&amp;b\'/></sm:url><url><loc><![CDATA[/c&d]]></loc></url></sm:urlset>')[1] == [("any", "/ar?a=1&b"), ("any", "/c&d")]
    assert e("<!-- <url> --><rdf:RDF><item><link>/x</link></item><loc>/first</loc></rdf:RDF>") == ("rdf", [("any", "/first"), ("any", "/x")])
    assert e('<feed><entry><link href="/1"/><link>/2</link></entry></feed>')[1] == [("any", "/1"), ("any", "/2")]
    assert e("<sitemapindex><loc>/no</loc><sitemap><loc>/1</loc></sitemap></sitemapindex>")[1] == [("sitemap", "/1")]
    assert e('[{"children": ["/m"], "link": {"href": "/deep"}, "note": "no"}, "/p", 3, null]')[1] == [("sitemap", "/m"), ("any", "/deep"), ("any", "/p")]
    assert e("{broken") == ("", []) and e("https://a.org/1\nno") == ("", []) and e("<a><html>")[0] == ""
    deep = '{"a":' * 900 + '["/x"]' + "}" * 900
    assert e(deep)[1] == [("any", "/x")]


def test_links_once_and_in_order(spark):
    page = '<link rel="alternate" hreflang="ar" href="/ar/only"><link rel="alternate" hreflang="ar" href="/long-path-1"><body><a href="/b">b</a><a href="/long-path-1">one</a><a href="/long-path-1#x">two</a><a href="/news">n</a><a href="mailto:x">m</a>'
    f = html.fields(pages(spark, page).withColumn("site", F.lit("https://a.org/")), "html", ("anchors", "links"))
    rows = sitemaps.page_links(f, "id", "url", "site").collect()
    assert [(r.url[13:], r.score, r.text) for r in sorted((r for r in rows if r.rank), key=lambda r: r.rank)] == [("/news", 5, "n"), ("/ar/only", 4, ""), ("/long-path-1", 1, "one"), ("/b", 0, "b")]
    assert [r.reason for r in rows if r.rank is None] == ["unsupported_scheme"]


def test_a_sitemap_met_again_is_judged_as_a_page(spark):
    body = "<urlset><url><loc>https://a.org/sitemap-2.xml</loc></url><url><loc>https://www.a.org/sitemap-2.xml</loc></url></urlset>"
    df = spark.createDataFrame([(1, "https://a.org/sitemap.xml", "https://a.org/", body)], "id int, base string, site string, body string")
    assert [(r.kind, r.reason) for r in sorted(sitemaps.listed(df, "id", "base", "site").collect(), key=lambda r: r.pos)] == [("sitemap", None), ("refused", "asset_file")]


def test_diagnosis(spark):
    fields = "url string, title string, description string, icon_url string, keywords string, snippet string, text string, quality string, status int, content_type string, error string, duration_ms long, browser_error string"
    rows = [("u", "t", "d", "i", "k", "s", " some  text ", "good", 200, "text/html", None, 5, "crashed"), ("u", "t", "", "i", "", "s", "x", "good", 200, "text/html", None, None, None), ("u", None, None, None, None, None, None, None, 503, None, "timeout " * 100, 9, None)]
    got = [r.diagnosis for r in extract.diagnosed(spark.createDataFrame(rows, fields)).collect()]
    assert [g.reason for g in got] == ["browser_fallback_failed", "missing_description_keywords", "fetch_timeout"]
    assert (got[0].text_length, got[0].excerpt, got[0].trace.duration_ms, got[0].trace.http_status) == (10, "some text", 5, 200) and got[1].missing_fields == ["description", "keywords"]
    assert got[2].quality == "unknown" and len(got[2].error) == 500 and got[2].observed.title == "" and got[2].trace.content_type == ""
