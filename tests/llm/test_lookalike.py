import unicodedata as U

from hypothesis import given, settings
from hypothesis import strategies as st

from raqim.llm import lookalike as L

RULES = L.form_table()
N = L.Normalizer(RULES)
COLUMNS = "id long, title string, snippet string, description string, title__ string"


def c(*codes):
    return "".join(map(chr, codes))


def test_forms():
    cases = {
        "Ｄｅｍａｎｄ": ("form", "Demand"), "e" + c(0x301) + "valuation": ("decomposed", "évaluation"), "ص" + c(0x200B) + "فحة": ("invisible", "صفحة"), "in" + c(0xA0) + "the": ("space", "in the"),
        "h" + c(0x430) + "ndling": ("foreign", "handling"), c(0xFEFB) + "زم": ("form", "لازم"), c(0x1D401) + "old": ("form", "Bold"),
    }
    for text, (kind, form) in cases.items():
        marks, out = N.scan(text)
        assert kind in marks and out == form, text


def test_what_writing_needs():
    fine = ["می" + c(0x200C) + "تواند گندم را در شهر", "Обзор: музеи в Velimor", "عِلْم و بَيْت", "“Wait” — it’s… done", "👨" + c(0x200D) + "👩" + c(0x200D) + "👧 at home", "❤" + c(0xFE0F), "x² ½ ™ 20 °C", ""]
    for text in fine:
        assert N.scan(text) == (set(), text), text


def test_arabic_with_persian_letters():
    marks, out = N.scan("مطلوب في المدينة جافاس" + c(0x6A9) + "ربت")
    assert marks == {"foreign"} and out.endswith("جافاسكربت")


def test_classes_are_transitive():
    assert RULES[c(0xFE8E)] == "ا"  # final alef
    assert all(RULES.get(x, x) == x for x in RULES.values())


LETTERS = "abcno éß ابكهي" + c(0x200B, 0x200C, 0x200D, 0xA0, 0xFF41, 0xFEFB, 0x301, 0x323, 0x430, 0x436, 0x3BF, 0x3C0, 0x6A9, 0x6CC, 0x6C1, 0x6C0, 0x67E, 0x585, 0x261, 0x212A, 0x1F468, 0x1112, 0x1161)


def test_the_gate_lets_no_rule_pass():
    for x in RULES:
        assert L.SUSPECT.part.fullmatch(x), ascii(x)


@settings(max_examples=2000, deadline=None)
@given(st.text(alphabet=st.sampled_from(LETTERS), max_size=40), st.sampled_from(["ar", "fa", "", None]))
def test_form_is_stable(text, lang):
    once = N.scan(text, lang)[1]
    assert N.scan(once, lang)[1] == once


def test_letters_of_other_scripts_inside_a_word():
    cases = {"g" + c(0x585) * 2 + "gle": "google", c(0x261) + "oogle": "google", "а".join("bc") + " а": "bac a", "م" + "درسoة": "مدرسoة", c(0x212A) + "elvin": "Kelvin", "か" + c(0x3099): "が", c(0x1112, 0x1161, 0x11AB): "한", "ê" + c(0x323): "ệ"}
    for text, form in cases.items():
        marks, out = N.scan(text)
        assert marks and out == form, text
    for text in ("الكتاب PDF", "ملف ووPDF", "Θ ≈ 45", "И это"):
        assert N.scan(text) == (set(), text)


def test_frequency_decides_among_plain_members(spark):
    k, persian = "ك", c(0x6A9)
    usual = L.form_table({"ar": {k: 100, persian: 3}, "fa": {}})
    turned = L.form_table({"ar": {k: 3, persian: 100}, "fa": {}})
    assert usual.words["ar"][persian] == k and turned.words["ar"][k] == persian
    assert L.Normalizer(turned).scan("في " + k + "تاب", "ar")[1] == "في " + persian + "تاب"
    counts = L.character_counts(spark.createDataFrame([("پ" + k,), (k * 3,), (None,)], "title string"), ["title", "snippet"])
    assert counts["ar"] == {k: 3} and counts["fa"] == {"پ": 1, k: 1}
    members = L.form_table().words
    assert members["C"]["o"] == members["C"][c(0x3BF)] == c(0x43E) and members["L"][c(0x3BF)] == members["L"][c(0x585)] == "o"  # one class, transitively


def test_operator_edges(spark):
    df = spark.createDataFrame([(1, None, "", None, "x"), (2, "Ｔ", "ok", "d", None), (2, "Ｔ", "ok", "d", None), (3, "x" * 100_000 + c(0x200B), None, None, None)], COLUMNS)
    got = sorted((r.id, r.field, tuple(r.kinds)) for r in L.marked(df).collect())
    assert got == [(2, "title", ("form",)), (2, "title", ("form",)), (3, "title", ("invisible",))]
    assert L.marked(df.limit(0)).count() == 0
