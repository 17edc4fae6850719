import random

from raqim.llm import mixing, packing, tokens

SIZES = "doc_id long, tokens long, capacity int"


def test_packing_is_whole_and_tight(spark):
    r = random.Random(1)
    data = [(i, r.choice([0, 1, 7, r.randint(1, 300), r.randint(200, 3000)]), 5) for i in range(3000)] + [(7, 40, 5), (7, 40, 5)]
    df = spark.createDataFrame(data, SIZES).drop("capacity")
    caps = spark.createDataFrame([("small", 128), ("large", 1000)], "container string, capacity int")
    got = packing.packed(df, caps).collect()
    for name, cap in (("small", 128), ("large", 1000)):
        rows = [x for x in got if x.container == name]
        assert sum(x.tokens for x in rows) == sum(n for _, n, _ in data)
        boxes = {}
        for x in rows:
            boxes.setdefault(x.container_no, []).append((x.start, x.tokens, x.slot))
        for b in boxes.values():
            b.sort()
            assert sum(t for _, t, _ in b) <= cap and [s for *_, s in b] == list(range(len(b)))
            assert all(a[0] + a[1] == c[0] for a, c in zip(b, b[1:]))
        split = {}
        for x in rows:
            split.setdefault((x.doc_id, x.copy), []).append(x.tokens)
        assert all(len(p) == 1 or sum(p) > cap for p in split.values())
        used = sum(x.tokens for x in rows) / (len(boxes) * cap)
        assert used > 0.97
        per = packing.report(spark.createDataFrame(rows)).collect()
        total = next(x for x in per if x.context is None)
        assert total.step_high - total.step_low <= 2 * cap and total.containers == len(boxes)
        assert {x.context for x in per} - {None} <= set(packing.contexts(cap)) and sum(x.tokens for x in per) == 2 * total.tokens
        assert all(x.tokens <= x.context and (x.tokens * packing.RATIO > x.context - packing.RATIO or x.context == packing.contexts(cap)[-1]) for x in rows)
    assert packing.packed(df.limit(0), caps).count() == 0


def test_tiers_change_the_plan_and_keep_the_fill(monkeypatch):
    r = random.Random(4)
    changed = 0
    for seed in range(6):
        counts = {x: r.randint(1, 9) for x in r.sample(range(1, 2049), 60) + r.sample(range(60, 500), 200)}
        tiered = packing.Plan(2048, counts)
        with monkeypatch.context() as m:
            m.setattr(packing, "LEAST", 10**6)  # a single tier: plain best fit
            flat = packing.Plan(2048, counts)
        assert tiered.containers <= flat.containers * 1.01 + 1
        changed += any((tiered.slots[x][1] != flat.slots[x][1]).any() if len(tiered.slots[x][1]) == len(flat.slots[x][1]) else True for x in counts)
    assert changed == 6


def test_hot_length_is_salted(spark, monkeypatch):
    monkeypatch.setattr(packing, "HOT", 50)
    df = spark.range(500).selectExpr("id as doc_id", "10L as tokens")
    caps = spark.createDataFrame([("c", 35)], "container string, capacity int")
    rows = packing.packed(df, caps).collect()
    assert len(rows) == 500 and len({(x.container_no, x.slot) for x in rows}) == 500 and max(x.container_no for x in rows) == 166


def test_mixing(spark):
    r = random.Random(2)
    docs = [(i, r.choice("aaaaaaabbbc"), r.randint(1, 400), "x") for i in range(2000)] + [(5000, None, 10, "x"), (5001, "a", 0, "x")]
    df = spark.createDataFrame(docs, "doc_id long, source string, tokens long, copies string")
    targets = spark.createDataFrame([("m", "a", 0.5, 1, 80000), ("m", "b", 0.3, 2, 80000), ("m", "c", 0.2, 3, 80000), ("big", "c", 0.9, 2, 10**9), ("big", "none", 0.1, 2, 10**9)], "mix_name string, source string, target_share double, max_repeats int, budget_tokens long")
    chosen = mixing.mixed(df, targets)
    rows = chosen.collect()
    assert len({(x.mix_name, x.doc_id) for x in rows}) == len(rows)
    limits = {("m", "a"): 1, ("m", "b"): 2, ("m", "c"): 3, ("big", "c"): 2}
    assert all(x.copies <= limits[x.mix_name, x.source] for x in rows)
    shares = {(x.mix_name, x.source): x for x in mixing.shares(chosen, targets).collect()}
    for s, want in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        assert abs(shares["m", s].actual_share - want) < 0.005
    total_c = sum(t for _, s, t, _ in docs if s == "c")
    assert shares["big", "c"].tokens == 2 * total_c and shares["big", "none"].tokens == 0
    assert sorted(mixing.mixed(df, targets).collect()) == sorted(rows)
    assert mixing.mixed(df.limit(0), targets).count() == 0


def test_copies_are_solved():
    classes = [(3, 10, 100), (6, 5, 400)]
    c = mixing._copies(classes, 250, 4)
    assert abs(sum(c[k] * t for k, _, t in classes) - 250) < 1e-6 and c[6] > c[3]
    assert mixing._copies(classes, 10**9, 4) == {3: 4.0, 6: 4.0}


def test_tokens():
    assert tokens.count(None) == 0 and tokens.count("") == 0 and tokens.count("the end") == 2
    long = "word " * 60_000
    whole = tokens.encoding(tokens.VOCABULARY)
    for text in (long, "ab c  " * 50_000, "x" * 150_000, "don't  \n 12 كتاب," * 15_000):
        assert tokens.count(text) == len(whole.encode_ordinary(text))
