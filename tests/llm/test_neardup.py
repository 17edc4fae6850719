import random

import numpy as np
import pandas as pd

from raqim.llm import neardup as N

SCHEMA = "id long, url string, title string, snippet string, a long"


def texts(n=160, seed=3):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)]
    base = [r.sample(vocabulary, r.randint(24, 60)) for _ in range(n // 8)]
    out = []
    for i in range(n):
        words = list(r.choice(base))
        for _ in range(r.randint(0, 14)):
            k = r.randrange(len(words))
            words[k] = r.choice([r.choice(vocabulary), f"x{i}"])
        r.shuffle(words)
        out.append((i, "u", " ".join(words[:5]), ", ".join(words[5:]), 7))
    return out + [(n, "u", out[0][2], out[0][3], 7), (n + 1, "u", None, None, None), (n + 2, "u", "", "few words", 1)]


def brute(data):
    sets = {i: set((f"{t or ''} {s or ''}").replace(",", "").split()) for i, _, t, s, _ in data}
    sets = {i: s for i, s in sets.items() if len(s) >= 24}
    ids = sorted(sets)
    return {(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.75}


def test_all_pairs_whatever_the_bucket(spark):
    data = texts()
    df = spark.createDataFrame(data, SCHEMA)
    want = brute(data)
    assert len(want) > 50
    for most, copies in ((N.MAX_BUCKET, N.COPIES), (4, 1)):  # with tiny buckets all three levels work, with tiny blocks copies are spread
        got = [(r.id_a, r.id_b) for r in N.duplicate_pairs(df, most=most, copies=copies).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_batches_and_partitions_make_no_difference(spark):
    data = texts(80, 9)
    want = brute(data)
    by_size = spark.createDataFrame(data, SCHEMA).repartitionByRange(6, "snippet")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for rows in (1, 7, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            got = [(r.id_a, r.id_b) for r in N.duplicate_pairs(by_size).collect()]
            assert len(got) == len(set(got)) and set(got) == want, rows
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_copies_are_paired_across_blocks(spark):
    words = " ".join(f"w{i}" for i in range(30))
    near = words.replace("w1 ", "v1 ")
    data = [(i, "u", words, None, 0) for i in range(25)] + [(100 + i, "u", None, near, 0) for i in range(7)]
    got = [(r.id_a, r.id_b) for r in N.duplicate_pairs(spark.createDataFrame(data, SCHEMA), copies=3).collect()]
    assert len(got) == len(set(got)) == 32 * 31 // 2


def test_a_long_chain_is_one_group(spark):
    data = [(i, "u", " ".join(f"w{j}" for j in range(4 * i, 4 * i + 40)), None, 0) for i in range(150)]
    assert {r.group for r in N.groups(spark.createDataFrame(data, SCHEMA)).collect()} == {0}


def test_groups(spark):
    data = texts(60, 5)
    want = brute(data)
    rows = {r.id: (r.group, r.links) for r in N.groups(spark.createDataFrame(data, SCHEMA)).collect()}
    assert sum(n for _, n in rows.values()) == 2 * len(want)
    for a, b in want:
        assert rows[a][0] == rows[b][0]


def test_schemes_cover_all_distances():
    for g, _, hi in N.ladder(500):
        assert N.distance_bound(hi) <= 2 * g - 1
    assert all(a[2] == b[1] for a, b in zip(N.ladder(500), N.ladder(500)[1:]))


def test_edges(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert N.duplicate_pairs(df).count() == 0 and N.groups(df).count() == 0
    long = " ".join(f"w{i}" for i in range(3000))
    same = spark.createDataFrame([(1, "", long, None, 0), (2, "", None, long, 0), (2, "", None, long, 0)], SCHEMA)
    assert [tuple(r) for r in N.duplicate_pairs(same).collect()] == [(1, 2)]


def test_partners_of_other_batches_share_a_key():
    for a, b in ((48, 60), (24, 32), (150, 199), (600, 800)):
        keys = []
        for i, n in enumerate((a, b)):
            batch = pd.DataFrame({"id": [i], "words": [np.arange(n, dtype=np.int32) * 7919]})
            keys.append({(k, s) for part in N._first_keys(0.75)([batch]) for k, s in zip(part["key"], part["scheme"], strict=True)})
        assert keys[0] & keys[1], (a, b)
