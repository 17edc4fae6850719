"""Keyword classification of texts over a two-level taxonomy.

The taxonomy is a parameter: a table (category, subcategory or null, keyword).  Its keywords are brought to the searchable
form and, in Arabic, given the six proclitic prefixes.  Texts become word runs; each word meets the keywords that begin with
it, by equality, and those whose words follow there are hits.  So the cost follows the words of a text and not the number
of keywords, and no phrase is built that begins like no keyword.  ``classify`` holds a taxonomy of bounded size in the Python
workers and judges a document at a time; a larger one is joined with the words of all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from raqim.functions import text
from raqim.session import checkpointed

PREFIXES = ("ال", "وال", "بال", "لل", "فال", "كال")
TITLE, DESCRIPTION, TEXT_MOST = 5, 3, 2
SUBCATEGORIES, CANDIDATES, KEYWORDS, ALL_KEYWORDS = 5, 5, 12, 16
#: A taxonomy table beyond so many keywords is joined by shuffle instead of being sent to all executors.
BROADCAST_KEYWORDS = 50_000
#: A taxonomy of so many forms and rows together at most is held by each Python worker (215 MB at the bound); a larger one is joined.
HELD = 1_000_000
#: In searchable text, signs that end a run of words, and anything between words; a term of Arabic words.
SIGNS, GAPS, ARABIC = re.compile(r"[^\w\s]+"), re.compile(r"\W+"), re.compile(r"[\u0600-\u06FF\s]+")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(category, subcategory, keyword) from a JSON file of categories with keywords_ar, keywords_en and subcategories."""
    data = spark.read.json(path, multiLine=True).select(F.explode("categories").alias("c"))
    words = lambda x: F.concat(F.coalesce(x["keywords_ar"], F.array()), F.coalesce(x["keywords_en"], F.array()))
    top = data.select(F.col("c.id").alias("category"), F.lit(None).cast("string").alias("subcategory"), F.explode(words(F.col("c"))).alias("keyword"))
    below = data.select(F.col("c.id").alias("category"), F.explode("c.subcategories").alias("s"))
    return top.union(below.select("category", F.col("s.id").alias("subcategory"), F.explode(words(F.col("s"))).alias("keyword")))


def _normal(taxonomy: DataFrame) -> DataFrame:
    """The taxonomy with each keyword's searchable term, of two letters at least."""
    return taxonomy.withColumn("term", text.searchable(F.col("keyword"))).filter(F.length("term") >= 2)


def _forms(term: Column) -> Column:
    """A term and, in Arabic, the same with each proclitic."""
    arabic = term.rlike(r"^[\x{0600}-\x{06FF}\s]+$")
    return F.array_distinct(F.when(arabic, F.concat(F.array(term), F.array(*(F.concat(F.lit(p), term) for p in PREFIXES)))).otherwise(F.array(term)))


def variants(taxonomy: DataFrame) -> DataFrame:
    """(category, subcategory, keyword, variant, words): the forms under which a keyword is found."""
    return _normal(taxonomy).select("category", "subcategory", "keyword", F.explode(_forms(F.col("term"))).alias("variant")).withColumn("words", F.size(F.split("variant", " ")))


def places(normal: Column, most: int) -> Column:
    """Each word of a searchable text with the run from it on, of at most ``most`` words, closed by a space: (word, run).  Signs other than
    letters, digits and spaces end a run."""
    runs = F.filter(F.split(F.regexp_replace(normal, r"[^\p{L}\p{N} ]+", "\n"), "\n"), lambda x: F.trim(x) != "")
    words = F.transform(runs, lambda r: F.filter(F.split(r, " "), lambda w: w != ""))
    at = lambda ws: F.transform(ws, lambda w, i: F.struct(w.alias("word"), F.concat(F.array_join(F.slice(ws, i + 1, most), " "), F.lit(" ")).alias("run")))
    return F.flatten(F.transform(words, at))


def hits(docs: DataFrame, taxonomy: DataFrame, key: str = "id") -> DataFrame:
    """(key, category, subcategory, keyword, title_hits, description_hits, text_hits, points) of keywords that occur.
    ``docs`` has the key, title, description and body; a title counts as text as well."""
    forms = variants(taxonomy).withColumn("word", F.substring_index("variant", " ", 1)).withColumn("variant", F.concat("variant", F.lit(" ")))
    size = forms.agg(F.max("words").alias("most"), F.count("*").alias("n")).first()
    most, small = size["most"] or 1, size["n"] <= BROADCAST_KEYWORDS
    t, d = text.searchable(F.col("title")), text.searchable(F.col("description"))
    fields = docs.select(key, t.alias("t"), d.alias("d"), text.searchable(F.col("body")).alias("b"))
    tagged = fields.select(key, F.explode(F.array(F.struct(F.lit("t").alias("f"), F.col("t").alias("x")), F.struct(F.lit("d").alias("f"), F.col("d").alias("x")), F.struct(F.lit("a").alias("f"), F.concat_ws(" ", "t", "d", "b").alias("x")))).alias("s"))
    words = tagged.select(key, F.col("s.f").alias("f"), F.explode(places(F.col("s.x"), most)).alias("p")).select(key, "f", "p.word", "p.run")
    found = words.join(F.broadcast(forms) if small else forms, "word").filter(F.startswith("run", "variant"))
    count = lambda f: F.sum(F.when(F.col("f") == f, 1).otherwise(0))
    per = found.groupBy(key, "category", "subcategory", "keyword").agg(count("t").alias("title_hits"), count("d").alias("description_hits"), F.least(count("a"), F.lit(TEXT_MOST)).alias("text_hits"))
    return per.withColumn("points", F.col("title_hits") * TITLE + F.col("description_hits") * DESCRIPTION + F.col("text_hits"))


def category_scores(found: DataFrame, key: str = "id") -> DataFrame:
    """(key, category, score, subcategories): a category's own points and those of its five best subcategories."""
    own = found.filter("subcategory is null").groupBy(key, "category").agg(F.sum("points").alias("own"))
    below = found.filter("subcategory is not null").groupBy(key, "category", "subcategory").agg(F.sum("points").alias("sub_score"))
    best = below.withColumn("r", F.row_number().over(Window.partitionBy(key, "category").orderBy(F.desc("sub_score"), "subcategory"))).filter(F.col("r") <= SUBCATEGORIES)
    subs = best.groupBy(key, "category").agg(F.sum("sub_score").alias("below"), F.transform(F.array_sort(F.collect_list(F.struct("r", "subcategory"))), lambda x: x["subcategory"]).alias("subcategories"))
    both = own.join(subs, [key, "category"], "full_outer")
    return both.select(key, "category", (F.coalesce("own", F.lit(0)) + F.coalesce("below", F.lit(0))).alias("score"), F.coalesce("subcategories", F.array().cast("array<string>")).alias("subcategories"))


#: Of a source whose text matches: the category it speaks for, a subcategory where that is new, the reason and its points.
SOURCES = "pattern string, category string, subcategory string, keyword string, points int"


def _told(docs: DataFrame) -> Column:
    """The text that the sources' patterns are held against."""
    return F.concat_ws(" ", *(text.searchable(F.col(c)) for c in ("source_url", "title", "body") if c in docs.columns))


def boosted(scores: DataFrame, docs: DataFrame, sources: list[tuple[str, str, str, str, int]], key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(scores, reasons: key, category, keyword, points): each source (a row of SOURCES) whose pattern the searchable text of source_url,
    title and body holds adds its points to its category, which is made with the subcategory where it is missing.  Of one
    category's sources the first that matches speaks."""
    told = _told(docs)
    rows = [F.when(told.rlike(p), F.struct(F.lit(c).alias("category"), F.lit(s).alias("subcategory"), F.lit(k).alias("keyword"), F.lit(n).alias("points"), F.lit(i).alias("i"))) for i, (p, c, s, k, n) in enumerate(sources)]
    each = docs.select(key, F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("x")).groupBy(key, F.col("x.category").alias("category")).agg(F.min_by("x", "x.i").alias("x"))
    reasons = each.select(key, "category", F.col("x.keyword").alias("keyword"), F.col("x.points").alias("points"), F.col("x.subcategory").alias("subcategory"))
    both = scores.join(reasons.select(key, "category", F.col("points").alias("extra"), F.col("subcategory").alias("new__")), [key, "category"], "full_outer")
    out = both.select(key, "category", (F.coalesce("score", F.lit(0)) + F.coalesce("extra", F.lit(0))).alias("score"), F.coalesce("subcategories", F.array("new__")).alias("subcategories"))
    return out, reasons.drop("subcategory")


def best(scores: DataFrame, key: str = "id") -> DataFrame:
    """(key, category, score, confidence, subcategories, candidates): the best category and up to five with their scores."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), "category")
    ranked = scores.withColumn("r", F.row_number().over(order)).withColumn("next", F.lead("score").over(order))
    top = ranked.filter(F.col("r") <= CANDIDATES).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("r", "category", "score", "subcategories", "next"))).alias("c"))
    first = F.get("c", F.lit(0))
    lead = (first["score"] - F.coalesce(first["next"], F.lit(0)) + F.least(first["score"], F.lit(10))) / 20
    listed = F.transform("c", lambda x: F.struct(x["category"].alias("category"), x["score"].alias("score"), x["subcategories"].alias("subcategories")))
    return top.select(key, first["category"].alias("category"), first["score"].alias("score"), F.round(F.greatest(F.least(lead, F.lit(0.99)), F.lit(0.05)), 3).alias("confidence"), first["subcategories"].alias("subcategories"), listed.alias("candidates"))


def matched_keywords(found: DataFrame, chosen: DataFrame, key: str = "id", most: int = KEYWORDS, reasons: DataFrame | None = None) -> DataFrame:
    """(key, keywords): of the best category (and the ``reasons`` of its sources) and its chosen subcategories, by points, each keyword once,
    at most twelve."""
    own = found.join(chosen.select(key, "category", "subcategories"), [key, "category"]).filter(F.col("subcategory").isNull() | F.array_contains("subcategories", F.col("subcategory")))
    own = own.select(key, "keyword", "points")
    if reasons is not None:
        own = own.unionByName(reasons.join(chosen.select(key, "category"), [key, "category"]).select(key, "keyword", F.col("points").cast(own.schema["points"].dataType)))
    per = own.groupBy(key, "keyword").agg(F.max("points").alias("points"))
    ranked = per.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("points"), "keyword"))).filter(F.col("r") <= most)
    return ranked.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "keyword"))), lambda x: x["keyword"]).alias("keywords"))


def _occurs(visible: Column, term: Column) -> Column:
    """Whether a searchable term, or in Arabic one with a proclitic, stands as whole words in a text of which signs are spaces."""
    has = lambda x: F.instr(visible, F.concat(F.lit(" "), x, F.lit(" "))) > 0
    with_prefix = F.exists(F.array(*map(F.lit, PREFIXES)), lambda p: has(F.concat(p, term)))
    return has(term) | (F.rlike(term, F.lit(r"^[\x{0600}-\x{06FF}\s]+$")) & with_prefix)


def confirmed_keywords(page: Column, visible: Column) -> Column:
    """The page's own keywords that its visible text confirms, of at least three letters, in order: (keyword, term)."""
    plain = F.concat(F.lit(" "), F.regexp_replace(visible, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    terms = F.transform(F.filter(F.split(page, r"[,;|]"), lambda x: F.trim(x) != ""), lambda x: F.struct(F.trim(x).alias("keyword"), text.searchable(x).alias("term")))
    return F.filter(terms, lambda x: (F.length(x["term"]) >= 3) & _occurs(plain, F.regexp_replace(x["term"], r"[^\p{L}\p{N}]+", " ")))


def with_confirmed(keywords: Column, confirmed: Column, most: int = ALL_KEYWORDS) -> Column:
    """Matched keywords followed by confirmed ones that none of them equals in searchable form, sixteen at most in all."""
    had = F.transform(keywords, text.searchable)
    new = F.filter(confirmed, lambda x, i: ~F.array_contains(had, x["term"]) & (F.array_position(F.transform(confirmed, lambda y: y["term"]), x["term"]) == i + 1))
    room = F.greatest(F.lit(most) - F.size(keywords), F.lit(0))
    return F.concat(keywords, F.slice(F.transform(new, lambda x: x["keyword"]), F.lit(1), room))


def index_keywords(values: Column) -> Column:
    """Labels and keywords of a page for the index: cleaned, once each, in order, joined by an Arabic comma."""
    cleaned = F.filter(F.transform(values, lambda x: text.collapse(x, 80)), lambda x: x != "")
    return F.array_join(F.array_distinct(cleaned), "، ")


#: What ``classify`` gives besides the key.
CLASSIFIED = (
    "category string, score bigint, confidence double, subcategories array<string>, keywords array<string>, status string, "
    "reasons array<struct<keyword:string,title_hits:bigint,description_hits:bigint,text_hits:bigint,points:bigint>>, candidates array<struct<category:string,score:bigint,subcategories:array<string>>>"
)


def held(taxonomy: DataFrame, most: int) -> tuple | None:
    """The taxonomy as (one, more, terms, parts), None beyond ``most`` forms and rows.  ``one`` has the numbers of the terms of a form of one word, ``more``
    by the first word those of longer forms with all words; a term has its text and (times, keyword, numbers of parts), a part (category, subcategory)."""
    per = _normal(taxonomy).groupBy("term").agg(F.collect_list(F.struct("category", "subcategory", "keyword")).alias("rows")).withColumn("forms", _forms(F.col("term")))
    if (per.agg(F.sum(F.size("forms") + F.size("rows"))).first()[0] or 0) > most:
        return None
    one: dict[str, tuple] = {}
    more: dict[str, tuple] = {}
    terms: list[tuple] = []
    parts: dict[tuple, int] = {}
    for batch in per.select("term", "forms", "rows").toArrow().to_batches(max_chunksize=1000):
        for term, forms, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for f in forms:
                ws = f.split(" ")
                if len(ws) == 1:
                    one[f] = (*one.get(f, ()), len(terms))
                else:
                    more[ws[0]] = (*more.get(ws[0], ()), (ws, len(ws), len(terms)))
            groups: dict[tuple, list[int]] = {}
            for (c, s, k), n in Counter((r["category"], r["subcategory"], r["keyword"]) for r in rows).items():
                groups.setdefault((n, term if k == term else k), []).append(parts.setdefault((c, s), len(parts)))
            terms.append((term, tuple((n, k, tuple(ps)) for (n, k), ps in groups.items())))
    return one, more, terms, list(parts)


def _found(fields: list[tuple[str, str, str]], one: dict, more: dict) -> dict[int, list[int]]:
    """How often each term occurs in the titles, the descriptions and whole texts of a document's rows."""
    counts: dict[int, list[int]] = {}

    def add(k: int, i: int, end: int) -> None:
        c = counts.get(k)
        if c is None:
            c = counts[k] = [0, 0, 0]
        c[2] += 1
        if end <= titles:
            c[0] += 1
        elif titles <= i and end <= described:
            c[1] += 1

    for row in fields:
        t, d, b = (SIGNS.sub(" | ", x).split() for x in row)
        words, titles, described = t + d + b, len(t), len(t) + len(d)
        for i, w in enumerate(words):
            if w in one:
                for k in one[w]:
                    add(k, i, i + 1)
            if w in more:
                for ws, n, k in more[w]:
                    if words[i : i + n] == ws:
                        add(k, i, i + n)
    return counts


def _confirmed(page: str, terms: str, fields: tuple[str, str, str]) -> list[tuple[str, str]]:
    """``confirmed_keywords`` of a document's own row; ``terms`` is the searchable form of ``page`` in which the separators are left."""
    plain = f" {GAPS.sub(' ', ' '.join(' '.join(x.split()) for x in fields))} "
    out = []
    for raw, term in zip(re.split("[,;|]", page), re.split("[,;|]", terms), strict=True):
        keyword, term = raw.strip(" "), " ".join(term.split())
        if keyword and len(term) >= 3:
            x = GAPS.sub(" ", term)
            if f" {x} " in plain or (ARABIC.fullmatch(x) and any(f" {p}{x} " in plain for p in PREFIXES)):
                out.append((keyword, term))
    return out


def _judged(rows: list[tuple], model: tuple, default: str, known: bool) -> tuple:
    """CLASSIFIED of the rows of one key: (title, description, body, page keywords, their terms, what sources say), the texts searchable but for white
    space.  Where the key is not ``known``, nothing is matched."""
    one, more, terms, parts = model
    found = [(c, terms[k]) for k, c in _found([r[:3] for r in rows], one, more).items()] if known else []
    each = [(term, k, ps, n * t, n * d, min(n * a, TEXT_MOST)) for (t, d, a), (term, groups) in found for n, k, ps in groups]
    total: dict[int, int] = {}
    for _, _, ps, t, d, a in each:
        points = t * TITLE + d * DESCRIPTION + a
        for p in ps:
            total[p] = total.get(p, 0) + points
    scores: dict = {}
    below: dict = {}
    for p, points in total.items():
        c, s = parts[p]
        scores.setdefault(c, 0)
        if s is None:
            scores[c] += points
        else:
            below.setdefault(c, []).append((-points, s))
    subs: dict = {c: [] for c in scores}
    for c, xs in below.items():
        best = sorted(xs)[:SUBCATEGORIES]
        scores[c] -= sum(x for x, _ in best)
        subs[c] = [s for _, s in best]
    told: dict = {}
    for x in sorted((x for r in rows for x in r[5] or ()), key=lambda x: x["i"]) if known else ():
        told.setdefault(x["category"], x)
    for c, x in told.items():
        scores[c] = scores.get(c, 0) + x["points"]
        subs.setdefault(c, [x["subcategory"]])
    ranked = sorted(scores, key=lambda c: (-scores[c], c is None, c or ""))
    category, score, confidence = (ranked[0], scores[ranked[0]], 0.0) if ranked else (None, 0, 0.0)
    if ranked:
        lead = (score - (scores[ranked[1]] if len(ranked) > 1 else 0) + min(score, 10)) / 20
        confidence = round(max(min(lead, 0.99), 0.05), 3)
    most: dict[str, tuple] = {}
    reasons = []
    if category is not None:
        own = {p for p, (c, s) in enumerate(parts) if c == category and (s is None or s in subs[c])} if found else ()
        for term, k, ps, t, d, a in each:
            points = t * TITLE + d * DESCRIPTION + a
            for p in ps:
                if p in own:
                    most[k] = max(most.get(k, (points, term)), (points, term))
                    if parts[p][1] is None:
                        reasons.append((k, t, d, a, points))
        if x := told.get(category):
            most[x["keyword"]] = max(most.get(x["keyword"], (0, "")), (x["points"], x["term"]))
            reasons.append((x["keyword"], 0, 0, 1, x["points"]))
    keywords = sorted(most, key=lambda k: (-most[k][0], k))[:KEYWORDS]
    had, room = {most[k][1] for k in keywords}, ALL_KEYWORDS - len(keywords)
    *field, page, page_terms, _ = rows[0]
    new: dict[str, str] = {}
    for k, term in _confirmed(page, page_terms, field) if page else ():
        if term not in had:
            new.setdefault(term, k)
    return (
        default if category is None else category, score, confidence, [] if category is None else subs[category], keywords + list(new.values())[:room], "candidate",
        sorted(reasons), [(c, scores[c], subs[c]) for c in ranked[:CANDIDATES]] or None,
    )


def _by_key(model: Callable[[], tuple], default: str, schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Judges rows that come ordered by key, all of a key together wherever a batch ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taxonomy, rows, key, out = model(), [], None, []
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, type=x.type) for c, x in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
        for b in batches:
            for k, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if rows and k != key:
                    out.append((key, *_judged(rows, taxonomy, default, key is not None)))
                    rows = []
                key = k
                rows.append(row)
            if out:
                yield batch()
                out = []
        if rows:
            out.append((key, *_judged(rows, taxonomy, default, key is not None)))
            yield batch()

    return run


def classify(docs: DataFrame, taxonomy: DataFrame, key: str = "id", default: str = "other", sources: list[tuple[str, str, str, str, int]] = ()) -> DataFrame:
    """One row per document: category, score, confidence, subcategories, keywords, status, reasons (keyword, title_hits, description_hits,
    text_hits, points of the category's own keywords and sources) and candidates; the default where nothing matches.  Where ``docs`` has
    page_keywords, those that the visible text confirms follow the matched ones."""
    model = held(taxonomy, HELD)
    if model is None:
        return _joined(docs, taxonomy, key, default, sources)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by HELD
    page = F.col("page_keywords") if "page_keywords" in docs.columns else F.lit(None).cast("string")
    told, fields = _told(docs), lambda c, s, k, n, i: {"category": F.lit(c), "subcategory": F.lit(s).cast("string"), "keyword": F.lit(k), "points": F.lit(n), "i": F.lit(i), "term": text.searchable(F.lit(k))}
    says = [F.when(told.rlike(p), F.struct(*(v.alias(c) for c, v in fields(*x, i).items()))) for i, (p, *x) in enumerate(sources)]
    ordered = docs.repartition(key).sortWithinPartitions(key)  # texts are brought to their searchable form after it, by all cores
    rows = ordered.select(
        key, *(text.searchable_parts(F.coalesce(c, F.lit("")), "").alias(c) for c in ("title", "description", "body")), page.alias("page"), text.searchable_parts(page, ",;|").alias("terms"),
        (F.filter(F.array(*says), lambda x: x.isNotNull()) if says else F.lit(None).cast("array<string>")).alias("says"),
    )
    kind = docs.select(key).schema
    out = StructType([*kind, *StructType.fromDDL(CLASSIFIED)])
    return rows.mapInArrow(_by_key(lambda: shared.value, default, to_arrow_schema(out)), out)


def _joined(docs: DataFrame, taxonomy: DataFrame, key: str, default: str, sources: list[tuple[str, str, str, str, int]]) -> DataFrame:
    """``classify`` with the taxonomy joined, whatever its size."""
    found = checkpointed(hits(docs, taxonomy, key))
    scores, why = category_scores(found, key), None
    if sources:
        scores, why = boosted(scores, docs, list(sources), key)
    chosen = checkpointed(best(scores, key))
    words = matched_keywords(found, chosen, key, reasons=why)
    kinds = [F.col(c).cast("long").alias(c) for c in ("title_hits", "description_hits", "text_hits", "points")]
    own = found.filter("subcategory is null").select(key, "category", "keyword", *kinds)
    if why is not None:
        own = own.unionByName(why.select(key, "category", "keyword", *(F.lit(n).cast("long").alias(c) for c, n in (("title_hits", 0), ("description_hits", 0), ("text_hits", 1))), F.col("points").cast("long").alias("points")))
    reason = F.struct("keyword", "title_hits", "description_hits", "text_hits", "points")
    reasons = own.join(chosen.select(key, "category"), [key, "category"]).groupBy(key).agg(F.array_sort(F.collect_list(reason)).alias("reasons"))
    none = F.array().cast("array<string>")
    columns = [key] + [c for c in ("page_keywords",) if c in docs.columns]
    joined = docs.dropDuplicates([key]).join(chosen, key, "left").join(words, key, "left").join(reasons, key, "left")
    keywords = F.coalesce("keywords", none)
    if len(columns) > 1:
        visible = F.concat_ws(" ", *(text.searchable(F.col(c)) for c in ("title", "description", "body")))
        keywords = with_confirmed(keywords, F.coalesce(confirmed_keywords(F.col("page_keywords"), visible), F.array().cast("array<struct<keyword:string,term:string>>")))
    return joined.select(
        key, F.coalesce("category", F.lit(default)).alias("category"), F.coalesce("score", F.lit(0)).alias("score"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("subcategories", none).alias("subcategories"),
        keywords.alias("keywords"), F.lit("candidate").alias("status"), F.coalesce("reasons", F.array().cast("array<struct<keyword:string,title_hits:bigint,description_hits:bigint,text_hits:bigint,points:bigint>>")).alias("reasons"), "candidates",
    )
