from raqim.llm import residue as R

SCHEMA = "id long, url string, title string, snippet string, field string"
P = "https://www.site-x.example/blog/page-one"


def test_rules(spark):
    case = [
        (1, P, "{{ title }} | Site", "fine text here."), (2, P, "Good title", "null"), (3, P, "Error 404 | Site", "x."), (4, P, "t", "Lorem ipsum dolor sit amet elit."), (5, P, "t", "Please enable JavaScript to view /blog/page-one"),
        (6, P, "t", "هذا نص تجريبي سيستبدل لاحقا"), (7, P, "[[+page.title]]", None), (8, P, "t", "A sentence here. [object Object]"), (9, P, "t", "Traceback (most recent call last): File \"/srv/x.py\", line 3"), (10, P, "t", "Before ${CITY} the team advises."),
        (11, P, "Untitled page", ""), (12, P, "t", "يرجى تفعيل جافاسكربت لعرض /blog/page-one"),
    ]
    fine = [
        (101, P, "Fixing error 404 pages in Norwich", "Norwich explains what an error 404 message means and how families repair dead links."), (102, P, "شرح الخطأ 404 في المدينة", "متى يحتاج الموقع إلى تفعيل جافاسكربت؟ يجيب المعهد."), (103, P, "Null results", "A short history of lorem ipsum and other filler in design."),
        (104, P, None, None), (105, P, "", ""), (106, None, "Zanulle", "The undefined borders of a country."),
    ] + [(110 + i, P, "t", f"Lesson {'abcde'[i]} a template variable is written as {{{{ name }}}} and filled in by the team {'abcde'[i]}.") for i in range(5)]
    df = spark.createDataFrame([(*r, "clash") for r in case + fine], SCHEMA)
    got = {(r.id, r.field) for r in R.residue(df).collect()}
    title = {1, 3, 7, 11}
    assert got == {(i, "title" if i in title else "snippet") for i, *_ in case}


def test_shared_pages_without_known_words(spark):
    rows = [(i, f"https://s{i}.example/p/q{i}x", "t", f"Kukulu mamo /p/q{i}x zet", "") for i in range(4)]
    got = {(r.id, r.field) for r in R.residue(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(i, "snippet") for i in range(4)}


def test_edges(spark):
    assert R.residue(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, None, None, None, None), (2, P, "x" * 100_000, "y " * 100_000, None)], SCHEMA)
    assert R.residue(df).count() == 0


def test_repeated_leaks_stay_marked(spark):
    leak = [(i, f"https://s{i}.example/p", "t", f"Welcome to {{{{ site_name }}}} in Cairo, guest {'abcdef'[i]}.", "") for i in range(6)] + [(10 + i, P, "t", "Opening hours of ${SHOP} in Leeds are long.", "") for i in range(3)]
    about = [(20, P, "t", "In this lesson a template variable is written as {{ name }} and filled in by a portal.", "")]
    about += [(21 + i, P, "t", f"The {'abc'[i]} team shows how templates get {{{{ city }}}} from a table.", "") for i in range(3)]
    got = {(r.id, r.field) for r in R.residue(spark.createDataFrame(leak + about, SCHEMA)).collect()}
    assert got == {(i, "snippet") for i, *_ in leak}


def test_messages_without_a_path(spark):
    rows = [(i, f"https://s{i}.example/p{i}", "Tea " + "abcd"[i], "You need to enable JavaScript to run this app.", "") for i in range(4)] + [(5, P, "t", "Access denied", "")]
    fine = [(9, P, "t", "Readers learn how to enable JavaScript in an old browser.", "")]
    got = {(r.id, r.field) for r in R.residue(spark.createDataFrame(rows + fine, SCHEMA)).collect()}
    assert got == {(i, "snippet") for i, *_ in rows}


def test_templates_without_known_words(spark):
    page = [(i, f"https://s{i}.example/a/p{i}", f"Zug {'abcdefgh'[i]} tal | S", f"Kelo munta {i} beri no salop", "") for i in range(6)]
    headed = [(20 + i, f"https://s{i}.example/b", "Vorim sala", f"Kelo munta {i} beri no salop" if i < 4 else f"An essay of {'abcdefgh'[i]} about rivers and how they bend.", "") for i in range(7)]
    copies = [(40 + i, f"https://s{i}.example/c", "One title", "A mirrored essay that all sites carry under its title.", "") for i in range(8)]
    lists = [(60 + i, f"https://s{i}.example/d", f"List {'abcdefgh'[i]}", f"https://a{i}.example/x | https://b{i}.example/y", "") for i in range(8)]
    got = {(r.id, r.field, r.rule) for r in R.residue(spark.createDataFrame(page + headed + copies + lists, SCHEMA)).collect()}
    assert got == {(i, "snippet", "template") for i, *_ in page} | {(20 + i, "snippet", "template") for i in range(4)} | {(20 + i, "title", "template") for i in range(7)}


def test_long_placeholders_and_values(spark):
    rows = [(1, P, "t", "Before {{ " + "a_long_name." * 20 + "title }} the team advises.", ""), (2, P, "t", "null, " * 60, ""), (3, P, "undefined " * 30, "Fine.", "")]
    got = {(r.id, r.field) for r in R.residue(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "snippet"), (2, "snippet"), (3, "title")}
