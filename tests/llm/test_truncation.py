import random

from raqim.llm import truncation as T

SCHEMA = "id long, url string, title string, snippet string, description string, cut string"
NAMES = ["Norwich", "Leeds", "York", "Derby", "Bath", "Ely"]


def corpus(n=400, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b = r.choice(NAMES), r.choice(["tea", "books", "maps", "trains", "roofs"])
        s = f"Demand for {b} in {a} grew by {r.randint(2, 90)} percent this week, yet moving {r.choice(['soup', 'wood', 'glass'])} lagged. The committee in {r.choice(NAMES)} reviews {b} before the holiday. In early spring the {r.choice(['office', 'garden', 'school'])} opens."
        d = f"Guide of {a} to choosing {b} and storing {r.choice(['soup', 'wood', 'glass'])} in early spring"
        out.append((1000 + i, f"https://s{i % 40}.example/{i}", f"{a}: {b}", s + r.choice(["", "\nShare this page", "\nSeen 44 times"]), d, ""))
    return out


def test_endings(spark):
    base = corpus()
    u = "https://s1.example/x"
    cut = [(1, "Demand for tea in Leeds grew by 5 perc"), (2, "Demand for maps in York grew by"), (3, "The committee in Bath reviews tea before…"), (4, "The committee in Bath reviews [...]"), (5, "Demand for tea in York grew &nbs"), (6, "Demand for tea <span class=\"no"), (7, "Demand for tea in Leeds \\u06"), (8, "Demand for tea %D8%"), (9, "Demand for te" + chr(0xFFFD)), (10, "The committee in Ely reviews tea... Read more")]
    fine = [(50, "Demand for tea in Leeds grew by 5 percent this week, yet moving soup lagged."), (51, "The committee in Bath reviews tea before the holiday.\nShare this page"), (52, None), (53, ""), (54, "tea, maps, tea, maps, tea, maps, tea, maps, tea, maps, tea, maps"), (55, "null")]
    rows = base + [(i, u, "t", s, None, "") for i, s in cut + fine] + [(60, u, "t", None, "Guide of Leeds to choosing tea and storing wood in early spring", "")]
    got = {(r.id, r.field) for r in T.truncated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(i, "snippet") for i, _ in cut}


def test_lengths():
    v = 'é"&\n'
    named = dict(zip(T.ENCODINGS, T.lengths(v)))
    assert named == {"characters": 4, "utf8": 5, "utf16": 4, "html": 4 + 5 + 4, "json": 4 + 1 + 1, "crlf": 5, "utf8_crlf": 6, "html_utf8": 5 + 5 + 4}


def test_edges(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert T.truncated(df).count() == 0 and T.report(df).count() == 0
    df = spark.createDataFrame([(1, None, None, None, None, None), (2, "u", None, "a b. " * 40_000, "x" * 50_000 + ".", None)], SCHEMA)
    assert T.truncated(df).count() == 0


def test_copies_are_no_evidence(spark):
    u = "https://s1.example/x"
    sentence, word = "Demand for tea in Leeds grew by", "The committee in Bath reviews tea before the holiday.\nDemand for maps in York grew by 5 perc"
    rows = corpus() + [(i, u, "t", sentence, None, "") for i in range(1, 401)] + [(i, u, "t", word, None, "") for i in range(401, 801)]
    rows += [(i, f"https://s{i % 7}.example/m", "t", "Demand for books in Ely grew by", None, "") for i in range(801, 900)]
    rows += [(i, "https://s9.example/y", "t", f"The committee in {NAMES[i % 6]} reviews tea before the holiday. Seen {'ab' * (i - 899)} now.\nDemand for tea in Leeds grew by", None, "") for i in range(900, 910)]
    got = {(r.id, r.field) for r in T.truncated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(i, "snippet") for i in range(1, 900)}  # the last ten end with a line of their site


def test_a_site_with_its_own_limit(spark):
    r = random.Random(7)
    words = "tea books maps trains roofs soup wood glass garden office spring holiday week demand committee".split()
    short = []
    for i in range(40):  # 60 bytes of UTF-8, cut behind whole words or not
        text = " ".join(["é" * (i % 5), *(r.choice(words) for _ in range(30))]).strip().encode()[:60].decode("utf-8", "ignore")
        short.append((i, "https://own.example/p", "t", None, text, ""))
    rows = short + corpus(600) + [(5000 + i, f"https://s{i % 40}.example/{i}", "t", None, " ".join(r.choice(words) for _ in range(r.randint(4, 12))), "") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: (r.cut, r.limit) for r in T.truncated(df).collect()}
    full = [i for i, *_, d, _ in short if len(d.encode()) == 60]
    assert len(full) > 30 and sum(got.get(i, ("", ""))[1] == "utf8 60" for i in full) >= 0.9 * len(full)
    per = {(r.site, r.field): (r.at_limit, r.limit) for r in T.report(df).collect()}
    assert per["own.example", "description"][1] == "utf8 60" and not any(x[1] for k, x in per.items() if k[0] != "own.example")
