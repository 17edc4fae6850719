import pytest

from raqim.llm import mojibake as M

SCHEMA = "doc_id long, text string, restored string"
TEXTS = {
    "ar": "تشير نتائج المعهد إلى أن تحديث المكتبات في المدينة قد سبق توسيع المدارس القديمة خلال الشتاء.",
    "fr": "Après l'été, la forêt près du château était déjà très fréquentée par les élèves du collège.",
    "ru": "Группа изучает музеи и книги возле города, а журнал описал огороды.",
    "en": "“It’s settled,” notes the café — at 20 °C the season is quiet.",
}
FINE = ["EDIÇÃO ESPECIAL: limões e câmaras em SÃO Norami", "Øen har 5152 årlige besøg af træer ved Ørebro.", "Θ ≈ 45° und Ω", "ÂGE 12, À PARIS", "", None, "naïve façade – 50 % · ±3 µm ½ ©", "کتاب‌های گندم در شهر"]


@pytest.mark.parametrize("pair", [("utf-8", "cp1252", 1), ("utf-8", "latin-1", 1), ("utf-8", "cp1252", 2), ("utf-8", "cp1256", 1), ("utf-8", "mac_roman", 1), ("utf-8", "cp437", 1)])
def test_exact_round_trip(pair):
    for t in TEXTS.values():
        assert M.restore(M.garble(t, *pair), *pair) == (t, 0)


def test_found_and_restored(spark):
    cases = [(t, p) for k, t in TEXTS.items() for p in (("utf-8", "cp1252", 1), ("utf-8", "cp1256", 1), ("utf-8", "mac_roman", 1), ("utf-8", "cp1252", 2))] + [(TEXTS["ar"], ("cp1256", "cp1252", 1)), (TEXTS["ar"], ("iso8859-6", "latin-1", 1)), (TEXTS["fr"], ("cp1252", "cp850", 1))]
    fine = list(TEXTS.values()) + FINE
    rows = [(i, t + "\n" + M.garble(t, *p), "") for i, (t, p) in enumerate(cases)] + [(1000 + i, t, "") for i, t in enumerate(fine)] + [(2000, "a wor" + chr(0xFFFD) + "d here", ""), (2001, "x " * 60_000, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.restored for r in M.garbled(df).collect()}
    assert set(got) == {*range(len(cases)), 2000}
    right = sum(got[i] == t + "\n" + t for i, (t, _) in enumerate(cases))
    assert right >= 0.85 * len(cases)
    assert M.garbled(df.limit(0)).count() == 0


def test_short_and_ordinary_looking_passages(spark):
    own = ["La ciudad tiene un corazón grande.", "España", "O João não vem ao centro.", "Han bor på landet og går på arbejde."]
    case = [M.garble(x, "cp1252", "cp1256") for x in own] + [M.garble("Le café est très bon", "cp1252", "cp437")]
    fine = [*TEXTS.values(), "ÂGE 12", "ÂGE 12, À PARIS", "ملف PDF جديد", "The word كتاب means book."]
    rows = [(i, t, "") for i, t in enumerate(case)] + [(100 + i, t, "") for i, t in enumerate(fine)]
    model = M.Model([*own, *fine, "Le café est très bon"] * 5)
    got = {r.doc_id: r.restored for r in M.garbled(spark.createDataFrame(rows, SCHEMA), model=model).collect()}
    assert set(got) == set(range(len(case)))


OWN = {"utf-8": "ar", "cp1256": "ar", "iso8859-6": "ar", "cp1251": "ru", "koi8-r": "ru", "cp866": "ru", "cp1252": "fr", "mac_roman": "fr", "cp437": "fr", "cp850": "fr"}


def test_every_pair_is_found_in_its_own_language(spark):
    texts = TEXTS | {"es": "La niña de España tiene un corazón más joven, según contó el señor."}
    own = {("cp1252", "cp1256"): "es"}  # that code page has the French letters at the same places
    rows = [(i, M.garble(texts[own.get((true, wrong), OWN[true])].replace("،", "").replace("œ", "oe"), true, wrong, times), "") for i, (true, wrong, times) in enumerate(M.PAIRS)]
    assert all(t for _, t, _ in rows)
    model = M.Model([*texts.values(), *(x for x in FINE if x)] * 5)
    got = {r.doc_id for r in M.garbled(spark.createDataFrame(rows, SCHEMA), model=model).collect()}
    assert got == set(range(len(rows))), [M.PAIRS[i] for i in set(range(len(rows))) - got]


def test_a_long_line_has_one_path(monkeypatch):
    model = M.Model([*TEXTS.values()] * 5)
    line = " ".join(M.garble(t, "utf-8", "cp1252") if i % 7 == 3 else t for i, t in enumerate([*TEXTS.values()] * 15))
    assert len(line) > 5000
    lines = [line, "short é", line[:900], TEXTS["ar"] * 3]
    batched = M._labels(model, lines)
    monkeypatch.setattr(M, "CELLS", 1)
    for one, x in zip(batched, lines, strict=True):
        assert (M._labels(model, [x])[0] == one).all() and len(one) == len(x)
    assert batched[0].any() and not batched[0].all()


def test_two_models_in_one_worker():
    first, second = M.Model([TEXTS["ar"]] * 3), M.Model([TEXTS["fr"], TEXTS["ru"]] * 3)
    text = [TEXTS["fr"] + " " + M.garble(TEXTS["fr"], "utf-8", "mac_roman")]
    fresh = []
    for m in (first, second):
        M._CACHE.clear()
        fresh.append(M._labels(m, text)[0])
    for m, want in ((first, fresh[0]), (second, fresh[1]), (first, fresh[0])):
        assert (M._labels(m, text)[0] == want).all()


def _emitted(model, state):
    """(character codes as probabilities alone, neighbours with theirs) of a state, by the characters themselves."""
    signs = {i: c for c, i in model.alphabet.items()}
    alone, keys, probs = model.sparse[model.pairs.index(state)]
    return {signs[i]: float(alone[i]) for i in signs}, {(signs[k // model.n], signs[k % model.n]): float(p) for k, p in zip(keys, probs, strict=True)}


def test_training_counts_all_lines(spark, monkeypatch):
    plain, other = [f"the tin hat no {i}" for i in range(1900)] + ["qzq"], [f"le café est où {i}" for i in range(2300)] + ["le dîner à cinq heures"]
    late = "x" * 3000 + " jamais trouvé ẞ"
    rows = [(i, t, "") for i, t in enumerate([*plain, *other, late])] + [(None, "ꙮ", ""), (9999, None, "")]
    model = M.train(spark.createDataFrame(rows, SCHEMA).repartition(5), rounds=0)
    assert {"ẞ", "î", "ù"} <= set(model.alphabet) and "ꙮ" not in model.alphabet
    # by hand: every other line as one, every ordinary line by one weight, built-in words five times
    weight = min(1, M.USUAL_SHARE * len([*other, late]) / len(plain))
    lines = [(x, 1) for x in [*other, late]] + [(x, weight) for x in plain] + [(x, 5) for x in M.SEED.values()]
    for state in (None, ("utf-8", "cp1252", 1), ("utf-8", "latin-1", 2), ("cp1252", "cp850", 1)):
        single, double, before = {}, {}, {}
        for x, w in lines:
            g = x if state is None else M.garble(x, *state)
            if g is None or state and g == x:
                continue
            for c in g:
                single[c] = single.get(c, 0) + w
            for a, b in zip(g, g[1:]):
                double[a, b] = double.get((a, b), 0) + w
                before[a] = before.get(a, 0) + w
        alone, pairs = _emitted(model, state)
        assert alone == pytest.approx({c: 1e-7 + single.get(c, 0) / sum(single.values()) for c in alone}, rel=1e-4)
        assert pairs == pytest.approx({k: n / (before[k[0]] + 2) for k, n in double.items()}, rel=1e-4)
    # neither how the lines come nor how the counts are held changes anything
    whole = M.Model([x for _, x, _ in rows[:-2]])
    monkeypatch.setattr(M, "DIRECT", 100)
    monkeypatch.setattr(M, "CHUNK", 50)
    again = M.Model([x for _, x, _ in rows[:-2]])
    for m in (whole, again):
        assert m.alphabet == model.alphabet and m.pairs == model.pairs
        assert all((x == y).all() for own, its in zip(m.sparse, model.sparse, strict=True) for x, y in zip(own, its, strict=True))
    text = [TEXTS["fr"] + " " + M.garble(TEXTS["fr"], "utf-8", "mac_roman")]
    searched = M._labels(again, text)[0]
    monkeypatch.undo()
    assert (M._labels(model, text)[0] == searched).all() and searched.any()


def test_garbled_lines_do_not_train(spark):
    own = "Selon la société, l'étude des épices à Paris a précédé l'élargissement du marché et la création du musée."
    short = "La société a décidé."
    fine = [(i, f"{own} {i}", "") for i in range(600)]
    bad = [(1000 + i, M.garble(f"{own} {i}\n{short}", "cp1252", "cp850"), "") for i in range(10)]
    bad += [(2000, M.garble(short, "cp1252", "cp850"), "")]
    df = spark.createDataFrame(fine + bad, SCHEMA)
    assert ("t", "Ú") in _emitted(M.train(df, rounds=0), None)[1]
    model = M.train(df)
    assert _emitted(model, None)[1].get(("t", "Ú"), 0) < 1e-3
    got = {r.doc_id: r.restored for r in M.garbled(df, model=model).collect()}
    assert got == {i: (f"{own} {i - 1000}\n{short}" if i < 2000 else short) for i, _, _ in bad}


def test_a_character_is_not_cut():
    model = M.Model(["Île verte", "Ïle", "Îlot", "où Θ est", "à 45°"] * 50 + [TEXTS["fr"]] * 50)
    for t in ("Θ ≈ 45°", "Ω → µ"):
        line = M.garble(t, "utf-8", "latin-1")
        labels = M._labels(model, [line])[0]
        labels[0] = 0  # as where the first of a character's bytes is a letter that often begins a line
        (a, b, new, failed), = M._spans(model, line, labels)
        assert (line[:a] + new + line[b:], failed) == (t, 0)
