"""Rows without a key, among others, in every operator."""

from raqim.llm import lookalike, mixing, mojibake, neardup, packing, residue, site_lines, stuffing, truncation

RESULTS = "id long, url string, title string, description string, keywords string, snippet string"
WORDS = " ".join(f"w{i}" for i in range(30))
U = "https://a.example/x"


def test_results(spark):
    rows = [(i, U, "{{ title }}", "cut here\u2026", "a,a,a,a,a", f"{WORDS}\nline \u200b") for i in (None, 1, 2, None)]
    df = spark.createDataFrame(rows, RESULTS)
    assert {tuple(r) for r in neardup.duplicate_pairs(df).collect()} == {(1, 2)}
    assert {r.id for r in stuffing.stuffing(df).filter("spam").collect()} == {1, 2}
    assert {r.id for r in truncation.truncated(df).filter("field = 'description'").collect()} == {1, 2}
    assert {r.id for r in lookalike.marked(df).collect()} == {1, 2}
    assert {r.id for r in residue.residue(df).collect()} == {1, 2}
    assert {r.id for r in site_lines.repeated_lines(df, 2).collect()} == {1, 2}


def test_documents(spark):
    bad = mojibake.garble("\u062a\u0634\u064a\u0631 \u0646\u062a\u0627\u0626\u062c \u0627\u0644\u0645\u0639\u0647\u062f", "utf-8", "cp1252")
    docs = spark.createDataFrame([(None, bad), (1, bad), (2, None)], "doc_id long, text string")
    assert [r.doc_id for r in mojibake.garbled(docs).collect()] == [1]
    sized = spark.createDataFrame([(None, "s", 5), (1, "s", 5), (2, "s", None)], "doc_id long, source string, tokens long")
    caps = spark.createDataFrame([("c", 10)], "container string, capacity int")
    assert [r.doc_id for r in packing.packed(sized, caps).collect()] == [1]
    targets = spark.createDataFrame([("m", "s", 1.0, 1, 100)], "mix_name string, source string, target_share double, max_repeats int, budget_tokens long")
    assert [r.doc_id for r in mixing.mixed(sized, targets).collect()] == [1]
