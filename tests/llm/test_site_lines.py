import random
import re
from collections import defaultdict

from raqim.llm import site_lines as S

SCHEMA = "id long, url string, snippet string, description string, line string"


def rows(n=60, seed=1):
    r = random.Random(seed)
    shared = ["Share | Save", "Seen 5 times", "Follow us", "Rights 2024", "Contact"]
    out = []
    for i in range(n):
        site = "a" if i % 3 else "b"
        values = []
        for _ in range(2):
            k = r.randint(0, 4)
            lines = [r.choice(shared).replace("5", str(r.randint(1, 99))) if r.random() < 0.7 else f"own {i} text {'abcdefgh'[r.randint(0, 7)]}" for _ in range(k)]
            values.append(r.choice(["\n", "\r\n", "\r"]).join(lines) if lines else None)
        out.append((i, f"https://{'www.' if i % 2 else ''}{site}.example/p/{i}", values[0], values[1], "clash"))
    return out


def brute(data, least):
    docs = defaultdict(set)
    where = defaultdict(list)
    for i, url, s, d, _ in data:
        site = re.sub("^www[.]", "", url.split("/")[2])
        for field, v in (("snippet", s), ("description", d)):
            for no, line in enumerate(re.split("\r\n|\n|\r", v) if v else [], 1):
                if line.strip():
                    key = (site, re.sub(r"\d+", "0", " ".join(line.lower().split())))
                    docs[key].add(i)
                    where[key].append((i, field, no))
    return {x for k, w in where.items() if len(docs[k]) >= least for x in w}


def brute_blocks(data, least):
    docs = defaultdict(set)
    for i, url, s, d, _ in data:
        site = re.sub("^www[.]", "", url.split("/")[2])
        for v in (s, d):
            keys = [re.sub(r"\d+", "0", " ".join(x.lower().split())) for x in re.split("\r\n|\n|\r", v)] if v else []
            for a in range(len(keys)):
                for b in range(a + 2, len(keys) + 1):
                    if all(keys[a:b]):
                        docs[site, tuple(keys[a:b])].add(i)
    return {k: len(v) for k, v in docs.items() if len(v) >= least}


def test_lines_and_blocks(spark):
    for seed in (1, 2):
        data = rows(seed=seed)
        df = spark.createDataFrame(data, SCHEMA)
        got = {(r.id, r.field, r.line_no) for r in S.repeated_lines(df, 5).collect()}
        assert got == brute(data, 5)
        all_ = brute_blocks(data, 5)
        right = {k: n for k, n in all_.items() if not any(o[0] == k[0] and len(o[1]) == len(k[1]) + 1 and o[1][:-1] == k[1] and m == n for o, m in all_.items())}
        found = sorted((r.lines, r.records) for r in S.blocks(df, 5).collect())
        assert found == sorted((len(k[1]), n) for k, n in right.items())


def test_cleaning(spark):
    data = [(i, "https://x.example/", f"Same line\r\nOwn {'abcdef'[i]}\r\nSame line", None, "") for i in range(5)] + [(9, "https://x.example/", "same   LINE", "", ""), (10, None, "Same line", None, "")]
    out = {r.id: (r.snippet, r.removed) for r in S.cleaned(spark.createDataFrame(data, SCHEMA)).collect()}
    assert out[0] == ("Own a", 2) and out[9] == ("", 1) and out[10] == ("Same line", 0)


def test_blocks_are_taken_out_whole(spark):
    foot = "Rights reserved\nContact us"
    data = [(i, "https://x.example/", f"Own {'abcdef'[i]} \u0001 kept\r\n{foot}\n", None, "") for i in range(5)] + [(9, "https://x.example/", "Contact us\nnothing\nRights reserved", foot, "")]
    df = spark.createDataFrame(data, SCHEMA)
    by_line = {r.id: (r.snippet, r.description, r.removed) for r in S.cleaned(df).collect()}
    by_block = {r.id: (r.snippet, r.description, r.removed) for r in S.cleaned(df, min_lines=2).collect()}
    assert by_line[0] == by_block[0] == ("Own a \u0001 kept", None, 2)
    assert by_line[9] == ("nothing", "", 4) and by_block[9] == ("Contact us\nnothing\nRights reserved", "", 2)


def test_windows_of_longer_blocks(spark):
    for seed in (3, 4):
        data = rows(seed=seed)
        docs, where = defaultdict(set), defaultdict(list)
        for i, url, *values, _ in data:
            site = re.sub("^www[.]", "", url.split("/")[2])
            for field, v in zip(("snippet", "description"), values, strict=True):
                keys = [re.sub(r"\d+", "0", " ".join(x.lower().split())) for x in re.split("\r\n|\n|\r", v)] if v else []
                for a in range(len(keys) - 1):
                    docs[site, *keys[a : a + 2]].add(i)
                    where[site, *keys[a : a + 2]] += [(i, field, a + 1), (i, field, a + 2)]
        want = {x for k, w in where.items() if len(docs[k]) >= 5 for x in w}
        got = [(r.id, r.field, r.line_no) for r in S.repeated_lines(spark.createDataFrame(data, SCHEMA), 5, 2).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, None, None), (2, "https://x.example", "", "\n\n", None), (3, "https://x.example", "a\n" * 50_000, None, None)], SCHEMA)
    assert S.repeated_lines(df, 1).filter("id < 3").count() == 0
    assert S.repeated_lines(df.limit(0)).count() == 0 and S.blocks(df.limit(0)).count() == 0
    again = spark.createDataFrame([(1, "https://x.example/", "l", None, None)] * 6, SCHEMA)
    assert S.repeated_lines(again, 2).count() == 0
