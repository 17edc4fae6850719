from raqim.functions import robots


def judge(spark, body, urls, tokens=("crawler",)):
    bodies = spark.createDataFrame([("o", body)], "origin string, body string")
    rules, maps = robots.parse(bodies, tokens=tokens)
    pages = spark.createDataFrame([("o", u) for u in urls], "origin string, url string")
    got = {r.url: r.allowed for r in robots.allowed(pages, rules).collect()}
    return [got[u] for u in urls], sorted(r.url for r in maps.collect())


def test_groups_and_ties(spark):
    body = "User-agent: *\nDisallow: /\n\nUser-agent: crawler\nDisallow: /private\nAllow: /private\nSitemap: https://a.org/s.xml\nDisallow: /x\n\nUser-agent: CRAW\nDisallow: /y\n"
    urls = ["https://a.org/private", "https://a.org/x/1", "https://a.org/y", "https://a.org/z", "https://a.org/robots.txt"]
    assert judge(spark, body, urls) == ([True, False, False, True, True], ["https://a.org/s.xml"])


def test_wildcards(spark):
    body = "user-agent: *\ndisallow: /*.pdf$\nallow: /open\ndisallow: /open/secret # why\n"
    urls = ["https://a.org/b.pdf", "https://a.org/b.pdfx", "https://a.org/open", "https://a.org/open/secret/1"]
    assert judge(spark, body, urls)[0] == [False, True, True, False]


def test_empty_rules_and_status(spark):
    assert judge(spark, "User-agent: a\nDisallow:\nUser-agent: crawler\nDisallow: /q\n", ["https://a.org/q", "https://a.org/r"])[0] == [False, True]
    rows = [("a", 200, bytearray(b"User-agent: *\n")), ("b", 404, None), ("c", 503, None), ("d", None, None), ("e", 429, None)]
    got = {r.origin: (r.deny_all, r.body) for r in robots.policies(spark.createDataFrame(rows, "origin string, status int, body binary")).collect()}
    assert got == {"a": (False, "User-agent: *\n"), "b": (False, None), "c": (True, None), "d": (True, None), "e": (True, None)}
