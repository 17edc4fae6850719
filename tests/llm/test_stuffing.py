from raqim.llm import stuffing as S

SCHEMA = "id long, snippet string, keywords string, spam boolean"
PROSE = "The library on the hill opens at nine, and the reading room stays quiet until the evening. Visitors may borrow a book for two weeks."
ARABIC = "تشير نتائج المعهد إلى أن تحديث المكتبات في المدينة قد سبق توسيع المدارس. يمكن للزوار قراءة الكتب في القاعة."


def test_spam_and_prose(spark):
    spam = ["shoes, sale, shoes, cheap, shoes, sale, shoes, cheap, shoes", "best phones best phones best phones best phones best phones", "https://a.example/x http://b.example/y www.c.example/z", "#one #two_three #four #five #six", "Home > News > Login > About > Phones > Tablets > Cameras", "\n".join(["cheap tea", "tea", "coffee", "tea", "sale", "tea", "coffee"]), "الأسنان لوم-74 متجر / القلب كور-2007 توصيل / الأسنان سيف-3931 عروض / الدواء فيل-786 توصيل / القلب خصم"]
    fine = [PROSE, ARABIC, PROSE + "\nShare | Save | Print", "The market sells apples, pears, plums, figs and dates in the old town.", "See https://a.example/page before you travel to the coast this week.", None, "", "короткая строка о музеях и книгах в городе."]
    rows = [(i, s, None, None) for i, s in enumerate(spam)] + [(100 + i, s, None, None) for i, s in enumerate(fine)] + [(200, PROSE, "tea, tea; tea، TEA, tea", None), (201, PROSE, "tea, tea, tea, coffee, cake", None), (202, None, None, None)]
    got = {r.id for r in S.stuffing(spark.createDataFrame(rows, SCHEMA)).filter("spam").collect()}
    assert got == {*range(len(spam)), 200}


def test_edges(spark):
    assert S.stuffing(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "word " * 50_000, "k," * 10_000, None), (1, "word " * 50_000, "k," * 10_000, None), (2, " \n ", " , ", None)], SCHEMA)
    assert [(r.id, r.spam) for r in S.stuffing(df).orderBy("id").collect()] == [(1, True), (2, False)]


def test_repeated_sentences_and_lines(spark):
    spam = ["Buy cheap shoes now! " * 10, "\n".join(["The best price for shoes in Leeds"] * 6)]
    fine = [PROSE, PROSE + " " + PROSE, ARABIC]
    rows = [(i, s, None, None) for i, s in enumerate(spam)] + [(100 + i, s, None, None) for i, s in enumerate(fine)]
    got = {r.id for r in S.stuffing(spark.createDataFrame(rows, SCHEMA)).filter("spam").collect()}
    assert got == {0, 1}


def test_duplicate_lines_and_longer_phrases():
    assert S.duplicates(["A b", "c", "a  B", "c"]) == [False, False, True, True]
    n, top, pairs, triples, quads, *_ = S.features("red tea cup now red tea cup now plain", "en")
    assert n == 9 and (pairs, triples, quads) == (6 / 8, 4 / 7, 2 / 6) and top == 2 / 9
    assert S.features("a b a c", "en")[2:5] == (0.0, 0.0, 0.0)


def test_limits_follow_the_language(spark):
    linked = [f"Read https://www.example.org/{'abcdefgh'[i % 8] * 14} on the way to the {i} of old" + "." for i in range(120)]
    rows = [(i, x, None, None) for i, x in enumerate(linked)] + [(1000 + i, ARABIC, None, None) for i in range(60)]
    found = spark.createDataFrame(rows, SCHEMA).select("id", "snippet").mapInPandas(S._units, S.UNITS)
    limits = S._limits(found)
    assert limits["ar"]["links"] == 0.4 < limits["en"]["links"] == 0.6 and limits["de"] == limits["*"]


def test_an_id_with_two_keyword_values(spark):
    rows = [(1, PROSE, "tea", None), (1, PROSE, "tea, tea, tea, tea, tea", None)]
    assert [(r.id, r.term, r.spam) for r in S.stuffing(spark.createDataFrame(rows, SCHEMA)).collect()] == [(1, 5, True)]
