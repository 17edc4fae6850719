import json

from pyspark.sql import functions as F

from raqim.operators import classify, discover, ingest, queue, state
from raqim.session import table
from raqim.streaming import loop

TAXONOMY = [("health", None, "طب"), ("health", None, "clinic"), ("health", "hospitals", "city hospital"), ("sports", None, "football"), ("sports", "teams", "team"), ("sports", None, "كرة")]


def test_classification(spark, tmp_path):
    tax = spark.createDataFrame(TAXONOMY, "category string, subcategory string, keyword string")
    docs = spark.createDataFrame([(1, "City hospital", "a clinic", "clinic clinic clinic"), (2, "Football", None, "the team plays football"), (3, "والطب الحديث", "", ""), (4, "footballer", "", "subclinical"), (5, None, None, None)], "id long, title string, description string, body string")
    hit = {(r.id, r.keyword): r.points for r in classify.hits(docs, tax).collect()}
    assert hit == {(1, "city hospital"): 6, (1, "clinic"): 3 + 2, (2, "football"): 5 + 2, (2, "team"): 1, (3, "طب"): 5 + 1}
    got = {r.id: (r.category, r.score, float(r.confidence), r.subcategories) for r in classify.classify(docs, tax).collect()}
    assert got[1] == ("health", 11, 0.99, ["hospitals"]) and got[2] == ("sports", 8, 0.8, ["teams"]) and got[4] == ("other", 0, 0.0, []) and got[5][0] == "other"
    full = {r.id: r for r in classify.classify(docs.withColumn("page_keywords", F.when(F.col("id") == 1, "City Hospital, CLINIC;x|hospital|clin| hospital ")), tax).collect()}
    assert full[1].keywords == ["city hospital", "clinic", "hospital"] and full[1].status == "candidate" and [(r.keyword, r.points) for r in full[1].reasons] == [("clinic", 5)]
    assert [(c.category, c.score, c.subcategories) for c in full[2].candidates] == [("sports", 8, ["teams"])] and full[5].candidates is None
    sourced = docs.withColumn("source_url", F.when(F.col("id").isin(2, 4), "https://clinic-one.org/x"))
    rules = [("clinic one", "health", "clinics", "clinic_source", 20), ("clinic", "health", "clinics", "later", 50)]
    got = {r.id: r for r in classify.classify(sourced, tax, sources=rules).collect()}
    assert (got[2].category, got[2].score, got[2].subcategories, got[2].keywords) == ("health", 20, ["clinics"], ["clinic_source"]) and got[4].category == "health" and got[1].score == 61
    data = {"categories": [{"id": "a", "keywords_ar": ["س ص"], "keywords_en": ["x"], "subcategories": [{"id": "b", "keywords_ar": [], "keywords_en": ["y"]}]}]}
    (tmp_path / "t.json").write_text(json.dumps(data, ensure_ascii=False), encoding="utf-8")
    assert {tuple(r) for r in classify.read_taxonomy(spark, str(tmp_path / "t.json")).collect()} == {("a", None, "س ص"), ("a", None, "x"), ("a", "b", "y")}


def test_classification_by_document(spark, monkeypatch):
    """A taxonomy of more than 50,000 forms is held, no word is shuffled, and the rows are those of the join."""
    words = [("health", None, "طب"), ("health", None, "Clinic"), ("health", None, "clinic"), ("health", "hospitals", "city hospital"), ("health", "hospitals", "city hospital"), ("sports", None, "football"), ("sports", "teams", "city"), ("news", None, "city hospital clinic"), ("news", "s1", "كرة القدم"), ("sports", "s1", "كرة القدم")]
    words += [("health", f"h{i}", w) for i, w in enumerate(["one", "two", "three", "four", "five", "six"])] + [(c, None, f"x{i}") for i in range(20) for c in ("many", "more")]
    filler = spark.range(60_000).selectExpr("'filler' as category", "cast(null as string) as subcategory", "concat('filler', id) as keyword")
    tax = spark.createDataFrame(words, "category string, subcategory string, keyword string").union(filler)
    rows = [
        (1, "City", "hospital clinic", "city\u00a0hospital\n\tclinic", "City Hospital; CLINIC|city hospital,,؟hospital"), (2, "كرة", "القدم؟ كرة القدم", "وكرة، القدم بالكرة", "كرة القدم،طب;القدم|كرة؟القدم"),
        (2, "clinic clinic", None, "والطب football", None), (3, None, None, None, "abc"), (4, "؟", "one two three four five six", "filler59999 city, hospital", " one ,six؛; seven|"), (5, " ".join(f"x{i}" for i in range(20)), "", " ".join(f"own{i}" for i in range(9)), ",".join(f"own{i % 10}" for i in range(300))),
        (None, "clinic", "clinic", "clinic", "Clinic"), (6, "٣٤ city_hospital", "K\u212aİ", "x1 x1 x1", ""),
    ]
    docs = spark.createDataFrame(rows, "id long, title string, description string, body string, page_keywords string").withColumn("source_url", F.when(F.col("id").isin(1, 3), "https://clinic-one.org"))
    sources = [("clinic one", "sports", "clinics", "Clinic source", 20), ("clinic", "sports", "later", "later", 50), ("one", "alone", "first", "one", 3)]
    docs = docs.filter("id <> 2 or page_keywords is not null").unionByName(docs.filter("id = 2 and page_keywords is null").withColumn("page_keywords", F.lit("كرة القدم،طب;القدم|كرة؟القدم")).withColumns({c: F.lit("كرة") for c in ("title",)}))
    for rules in ((), sources):
        got = classify.classify(docs, tax, sources=rules)
        assert "Generate" not in (plan := got._jdf.queryExecution().toString()) and "Join" not in plan
        with monkeypatch.context() as m:
            m.setattr(classify, "HELD", 10)
            want = classify.classify(docs, tax, sources=rules)
        assert got.schema.simpleString() == want.select(*got.columns).schema.simpleString()
        order = lambda r: (r.id is None, r.id)
        assert sorted(got.collect(), key=order) == sorted(want.select(*got.columns).collect(), key=order)
    assert len(got.filter("id = 5").first().keywords) == 16 and got.count() == 7


def test_queue(spark):
    rows = [(1, "u1", "processing", 1), (2, "u2", "needs_review", 1), (3, "u3", "queued", 0), (4, "u4", "corrupt", 3)]
    q = spark.createDataFrame(rows, "id long, url string, crawl_status string, crawl_attempts int")
    batch = queue.acquire(q, 5)
    assert sorted((r.id, r.phase) for r in batch.collect()) == [(1, "pending"), (3, "pending")]
    after = {r.id: (r.crawl_status, r.crawl_attempts) for r in queue.mark(q, batch.filter("id = 3")).collect()}
    assert after == {1: ("pending", 1), 2: ("needs_review", 1), 3: ("processing", 1), 4: ("corrupt", 3)}
    assert [r.id for r in queue.acquire(q.filter("id in (2, 4)"), 5).collect()] == [2]
    shards = [{r.id for r in queue.claim(q, 9, "w", i, 3).collect()} for i in range(3)]
    assert set.union(*shards) == {3} and sum(map(len, shards)) == 1
    capped = queue.capped(spark.createDataFrame([(1, i) for i in range(10)], "site_id int, pos int"), 4, accepted=spark.createDataFrame([(1, 1)], "site_id int, accepted int"))
    assert [(r.pos, r.left) for r in capped.orderBy("pos").collect()] == [(0, 7), (1, 7), (2, 7)]
    steps = queue.milestones(spark.range(1, 11).toDF("id"), "id")
    assert [r.percent for r in steps.orderBy("id").collect()] == [20, 40, 60, 80, 100]


def test_progress_and_caps_without_one_task(spark):
    many = spark.range(0, 10_000, 1, 7).select((F.col("id") * 7919 % 10_007).alias("at"))
    got = queue.milestones(many, "at").orderBy("n").collect()
    assert [(r.n, r.of, r.percent) for r in got] == [(n, 10_000, n // 100) for n in (2000, 4000, 6000, 8000, 10_000)]
    pages = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).otherwise(2).alias("site_id"), (F.col("id") * 37 % 3001).alias("pos"))
    capped = queue.capped(pages, 25)
    want = {s: sorted(r.pos for r in pages.filter(F.col("site_id") == s).collect())[:25] for s in (1, 2)}
    assert {s: sorted(r.pos for r in capped.filter(F.col("site_id") == s).collect()) for s in (1, 2)} == want
    assert {(r.site_id, r.left) for r in capped.collect()} == {(1, 1975), (2, 975)}


def test_state(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", "x", "t1"), (2, "b", "y", "t1")], "id long, url string, title string, updated_at string")
    new = spark.createDataFrame([(7, "a", "x2", "t2"), (8, "a", "x1", "t1"), (9, "c", "z", "t2")], "id long, url string, title string, updated_at string")
    got = {r.url: (r.id, r.title) for r in state.upsert(old, new).collect()}
    assert got == {"a": (1, "x2"), "b": (2, "y"), "c": (9, "z")}
    assert [r.id for r in state.insert_or_ignore(old, new).collect()] == [9] and [r.id for r in state.delete(old, new.select(F.lit(1).alias("id"))).collect()] == [2]
    snap = state.Snapshots(spark, str(tmp_path))
    assert snap.replace(old).count() == 2 and snap.replace(snap.read().union(new)).count() == 5


def test_ingest(spark):
    rows = [(1, 1, "a.org/x", "First", "", None), (1, 2, "a.org/x", "Second", "d", None), (2, 3, "", "bad", "", None), (2, 4, "b.org", "", "", "body  text")]
    df = ingest.rows(spark.createDataFrame(rows, "request int, id int, url string, title string, description string, content string"))
    assert [(r.id, r.search_text, r.valid) for r in df.orderBy("id").collect()] == [(1, "First a.org", True), (2, "Second d a.org", True), (3, "bad", False), (4, "body text b.org", True)]
    assert {r.id for r in ingest.accepted(df, "request").collect()} == {1, 2}
    assert ingest.display(df.filter("request = 1"), "id").first().title == "First"
    texts = ingest.search_texts(df, "id")
    assert {r.url: r.search_text for r in texts.collect()}["https://a.org/x"] == "Second d a.org"
    index = ingest.inverted(texts)
    assert {(r.term, tuple(r.positions)) for r in index.filter("url like '%a.org%'").collect()} == {("second", (0,)), ("d", (1,)), ("a", (2,)), ("org", (3,))}
    assert ingest.search(index, ["second"], 2).first().url == "https://a.org/x"


def test_requests(spark):
    rows = [(1, '[{"url": "a.org", "title": "t"}, {"page_url": "b.org", "content": "c"}]'), (2, '{"rows": [{"url": "c.org"}]}'), (3, '{"url": "d.org", "title": "x"}'), (4, "not json"), (5, "[]"), (6, json.dumps([{"url": "e.org"}] * 101)), (7, None)]
    got = ingest.read_requests(spark.createDataFrame(rows, "request int, body string"), "request")
    assert [(r.request, r.pos, r.url or r.page_url) for r in got.orderBy("request", "pos").collect()] == [(1, 0, "a.org"), (1, 1, "b.org"), (2, 0, "c.org"), (3, 0, "d.org")]
    sizes = ingest.chunks(spark.range(0, 1000, 1, 3), 100).groupBy("chunk").count().collect()
    assert max(r["count"] for r in sizes) == 100 and sum(r["count"] for r in sizes) == 1000


def test_shipping(spark, tmp_path):
    table_ = spark.range(5).withColumn("discovery_cursor", F.lit("{}"))
    assert state.delete_shipped(table_, spark.range(2)).count() == 3
    try:
        state.delete_shipped(table_, spark.range(4, 7))
        raise AssertionError("rows that aren't there were deleted")
    except ValueError:
        pass
    state.append_events(table_, str(tmp_path / "e"))
    state.append_events(table_, str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "e")).count() == 10
    cursors = spark.createDataFrame([(1, ["a"], 7)], "id long, pendingSitemaps array<string>, currentPageIndex int")
    got = {r.id: r.discovery_cursor for r in state.with_cursor(table_, cursors).collect()}
    assert json.loads(got[1]) == {"pendingSitemaps": ["a"], "currentPageIndex": 7} and got[0] == "{}"
    state.write_manifest(table_, str(tmp_path / "m"))
    assert {r.id for r in state.read_manifest(spark, str(tmp_path / "m")).collect()} == set(range(5))
    sent = state.shipped_in_chunks(table_, lambda rows: len(rows), 2)
    assert {r.id for r in sent.collect()} == set(range(5))
    tries = tmp_path / "tries"

    def flaky(rows):
        n = int(tries.read_text()) if tries.exists() else 0
        tries.write_text(str(n + 1))
        if n < 2:
            raise OSError("again")
        return len(rows)

    assert state.shipped_in_chunks(table_.coalesce(1), flaky, 9).count() == 5 and tries.read_text() == "3"
    try:
        state.shipped_in_chunks(table_, lambda rows: 0, 2).collect()
        raise AssertionError("rows that were not accepted passed")
    except Exception as e:
        assert "accepted" in str(e)
    left, right = state.split_columns(table_, "id", ["discovery_cursor"], [])
    assert left.columns == ["id", "discovery_cursor"] and right.columns == ["id"]


def test_frontier(spark):
    edges = spark.createDataFrame([("r", "a"), ("a", "b"), ("b", "r"), ("r", "b"), ("b", "c")], "parent string, child string")
    start = spark.createDataFrame([("r", "r")], "root string, node string")
    assert {(r.node, r.depth) for r in discover.reach(edges, start).collect()} == {("r", 0), ("a", 1), ("b", 1), ("c", 2)}
    chain = spark.createDataFrame([(str(i), str(i + 1)) for i in range(60)], "parent string, child string")
    assert discover.reach(chain, spark.createDataFrame([("x", "0")], "root string, node string")).agg(F.max("depth")).first()[0] == 60


def test_best_first_goes_by_score_over_all_depths(spark):
    links = [("h", "a", 1, 3), ("h", "b", 9, 1), ("h", "c", 2, 2), ("b", "d", 5, 1), ("b", "h", 9, 2), ("d", "e", 9, 1), ("c", "f", 8, 1), ("z", "y", 1, 1)]
    edges = spark.createDataFrame(links, "parent string, child string, score int, rank int")
    start = spark.createDataFrame([("h", "h"), ("z", "z")], "root string, node string")
    got = discover.best_first(edges, start, 6, 2).orderBy("root", "visit").collect()
    assert [(r.node, r.depth) for r in got if r.root == "h"] == [("h", 0), ("b", 1), ("d", 2), ("c", 1), ("f", 2), ("a", 1)]
    assert [r.node for r in got if r.root == "z"] == ["z", "y"]
    assert discover.best_first(edges, start, 2).count() == 4


def test_a_sites_run(spark):
    sites = spark.createDataFrame([(1, "https://a.org"), (2, "https://b.org"), (3, "https://c.org")], "id long, url string")
    base = "https://a.org/"
    docs = [("m0", True, None), ("m1", True, None), ("m2", True, None), ("closed", True, None), ("gone", False, "http_404"), ("bad", True, None)]
    documents = spark.createDataFrame([(base + u, ok, why) for u, ok, why in docs], "url string, ok boolean, reason string")
    rows = [("m0", "sitemapindex", i, "sitemap", x) for i, x in enumerate(["m2", "m1", "closed", "gone", "bad"])]
    rows += [("m2", "urlset", 0, "page", "p2"), ("m2", "urlset", 1, "page", "private/x"), ("m2", "urlset", 2, "sitemap", "m0"), ("m1", "urlset", 0, "page", "p2"), ("m1", "urlset", 1, "page", "p1"), ("closed", "urlset", 0, "page", "hidden"), ("bad", "", None, None, None)]
    listed = spark.createDataFrame([(base + u, f, p, k, base + t if t else None) for u, f, p, k, t in rows], "url string, format string, pos long, kind string, target string")
    rules = spark.createDataFrame([(1, False, "/private"), (1, False, "/closed")], "site_id long, allow boolean, pattern string")
    seeds = spark.createDataFrame([(1, base + "m0", 0), (2, "https://b.org/m", 0)], "site_id long, url string, pos int")
    walk = discover.sitemap_walk(seeds, documents, listed, rules)
    got = [(r.url[14:], r.outcome, r.reason) for r in walk.filter("site_id = 1").orderBy("turn").collect()]
    assert got == [("m0", "parsed", None), ("m2", "parsed", None), ("m1", "parsed", None), ("closed", "skipped", "robots_disallowed"), ("gone", "failed", "http_404"), ("bad", "invalid", "unrecognized_sitemap_format")]
    assert discover.sitemap_walk(seeds, documents, listed, rules, 2).filter("site_id = 1").count() == 2
    pages = discover.found_pages(walk, listed, rules=rules)
    assert [r.url[14:] for r in pages.orderBy("turn", "pos").collect()] == ["p2", "p1"]
    known = spark.createDataFrame([(1, base + "p2")], "site_id long, url string")
    assert [r.url[14:] for r in discover.found_pages(walk, listed, known, rules, 2).collect()] == ["p1"] and discover.found_pages(walk, listed, known, rules, 1).count() == 0
    denied = spark.createDataFrame([(3,)], "site_id long")
    runs = {r.site_id: (r.status, r.reason, r.sitemaps, r.valid_sitemaps, r.pages_added, r.feeds_wanted) for r in discover.runs(sites, walk, pages, denied).collect()}
    assert runs == {1: ("completed", None, 6, 3, 2, False), 2: ("not_pages", None, 1, 0, 0, True), 3: ("pending", "robots_txt_unreachable_fail_closed", 0, 0, 0, False)}
    states = spark.createDataFrame([(1, "completed"), (2, "not_pages"), (3, "pending"), (4, "incomplete"), (5, "pending")], "id long, crawl_status string")
    assert [r.id for r in discover.chosen_sites(states, limit=None).collect()] == [3, 5, 2] and [r.id for r in discover.chosen_sites(states, True, None).collect()] == [3, 5, 2, 4] and discover.chosen_sites(states).first().id == 3


def test_stream(spark, sf, tmp_path):
    static = table(spark, sf, "crawler_attempts").select("status", "started_at", "completed_at")
    folder, seen = str(tmp_path / "in"), []
    static.repartition(3).write.parquet(folder)
    stream = loop.read_stream(spark, folder, static.schema, 1)
    loop.run_available(stream, lambda df, i: seen.append(df.count()), str(tmp_path / "c"))
    assert sum(seen) == static.count() and len(seen) == 3
    rates = loop.attempt_rates(loop.read_stream(spark, folder, static.schema), late="4000 days").writeStream.format("memory").queryName("rates").outputMode("complete").trigger(availableNow=True).start()
    rates.awaitTermination()
    assert spark.table("rates").agg(F.sum("attempts")).first()[0] == static.count()
