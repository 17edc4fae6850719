"""Problem 2: keyword-stuffed and link-list records.

A snippet is cut into units (lines, and sentences of a line).  Each unit gets the shares the method names: its top word, its
repeated phrases of two, three and four words, link text, separators and function words; the snippet as a whole gives the
share of its text in lines and sentences that repeat an earlier one, and in phrases it holds three times.  What is normal
differs by language, so all limits are quantiles of the units that end like sentences, per language, over the whole corpus (a
table of one row per language); each quantile is held inside a fixed range, so that a corpus of spam cannot move it far.
A unit beyond its language's limits is no sentence; a record is spam if more than half of its snippet's characters lie in such
units, or if one keyword occurs five times or more.

Edge cases: rows without a key are left out; null and empty snippets or keywords count as not stuffed; a language with fewer than ``MIN_UNITS`` sentences
uses the limits of all languages together; keywords are compared in consistent form; repeated rows are judged alike; of an id's
different keyword values the most repetitive counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raqim.llm.lookalike import SUSPECT, form_table, language, normalizer
from raqim.llm.residue import PLACEHOLDER
from raqim.session import checkpointed

#: Function words by language.
FUNCTION_WORDS = {
    "ar": "في من إلى على عن مع هذا هذه ذلك التي الذي أن إن لا ما لم لن قد كما بين بعد قبل عند كل أو ثم حتى منذ خلال كان هو هي يمكن نحو بينما لماذا كيف حيث إذا دون بلا غير أي يليها وقد بحسب",
    "en": "the a an of and or to in for on from with by at is are was were be this that these those it its as not but if then than into over before after until while yet may can will has have had which who how why when we you they your our so do does did there here no one",
    "fr": "le la les un une des du de d l et ou à au aux en dans pour par sur avec sans sous ce cette ces il elle ils elles on nous vous que qui quoi ne pas plus est sont a ont été être avant après durant selon puis depuis toujours t y se sa son ses leur pourquoi comment",
    "fa": "در را و به از که این با می است برای یک شد هم آن تا بر نیز هر خود های",
    "ru": "и в на с по из у за о об что как это не но от до для при возле к а или же бы",
    "da": "og i på af til ved med har en et den det er som for ikke der at fra om de",
    "pt": "o a os as um uma de do da dos das e em no na nos nas por para com que se não é há ao à",
    "es": "el la los las un una de del y en por para con que se no es al lo su",
    "de": "der die das und in zu den mit von für auf ist im dem nicht ein eine als auch es an",
}
_FUNCTION = {k: frozenset(v.split()) for k, v in FUNCTION_WORDS.items()}
_SPOKEN = {w: tuple(k for k in _FUNCTION if w in _FUNCTION[k]) for words in _FUNCTION.values() for w in words}
ARABIC = re.compile(r"(?<!\w)[؀-ۿ]{2,}")
PERSIAN = re.compile("[گپچژیک]")
MIN_UNITS = 50
MAX_TERM = 5
URL = re.compile(r"(?:https?://|www\.)[^\s,;|<>\"'،؛]+|(?<![\w@.])(?:[a-z0-9\-]+\.)+(?:[a-z]{2,})(?:/[^\s,;|]*)?(?![\w@])", re.IGNORECASE)
TAG = re.compile(r"#[\w\-]+")
WORD = re.compile(r"[^\W_]+(?:[ً-ْ'’][^\W_]*)*")
SEPARATOR = re.compile(r"\s[-–—/|>»·•*~]\s|[|•·>»]|\s{2,}|[,،;؛/](?=\s)|,(?=\S)|،(?=\S)")
BREAK = re.compile(r"\r\n|\n|\r")
SENTENCE = re.compile(r"(?<=[.!?؟…])[\"”»)\]]*\s+")
ENDS = re.compile(r"[.!?؟…][\"”»)\]\s]*$")
KEYWORDS = re.compile(r"[,،;؛|\n]")


def tongue(text: str) -> str:
    """The language of a value, by script and function words; '' where no list has a word of it."""
    low = text.lower()
    if len(ARABIC.findall(low)) * 2 > len(low.split()):
        return "fa" if PERSIAN.search(low) and language(text) == "fa" else "ar"
    votes = Counter(k for w in WORD.findall(low) for k in _SPOKEN.get(w, ()))
    return max(votes, key=lambda k: (votes[k], k == "en", k)) if votes else ""


def units(text: str) -> list[str]:
    """Sentences of the lines; neighbouring short lines without an end stop are one unit, so lists by line are seen whole."""
    out: list[str] = []
    short: list[str] = []

    def flush() -> None:
        if len(short) >= 4:
            out.append(" | ".join(short))
        else:
            out.extend(short)
        short.clear()

    for line in BREAK.split(text):
        line = line.strip()
        if not line:
            continue
        parts = SENTENCE.split(line)
        for i, part in enumerate(parts):
            part = part.strip()
            if not part:
                continue
            if i == len(parts) - 1 and not ENDS.search(part) and len(part.split()) <= 6:
                short.append(part)
            else:
                flush()
                out.append(part)
    flush()
    return out


FEATURES = ("words", "top", "pairs", "triples", "quads", "distinct", "function", "links", "separators", "ends")


def _repeated(words: list[str], n: int) -> float:
    """The share of the n-word phrases that occur more than once."""
    phrases = Counter(zip(*(words[i:] for i in range(n))))  # noqa: B905
    return sum(c for c in phrases.values() if c > 1) / max(1, len(words) - n + 1)


def features(unit: str, lang: str) -> tuple:
    """The values of FEATURES: words, top-word share, shares of repeated phrases of two to four words, share of different words,
    function-word share, link share, separators a word, whether it ends like a sentence."""
    links, bare = 0, unit
    if "." in unit.rstrip(".") or "#" in unit:
        bare = TAG.sub(" ", URL.sub(" ", unit))
        links = sum(len(m) for m in URL.findall(unit)) + sum(len(m) for m in TAG.findall(unit))
    words = WORD.findall(bare.lower())
    n = len(words)
    if not n:
        return 0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, links / max(1, len(unit)), 0.0, bool(ENDS.search(unit))
    top = max(Counter(words).values())
    different = len(set(words))
    grams = [0.0, 0.0, 0.0]
    if different < n:
        for i in (2, 3, 4):
            grams[i - 2] = _repeated(words, i)
            if not grams[i - 2]:  # no longer phrase is repeated either
                break
    function = sum(w in _FUNCTION[lang] for w in words) if lang in _FUNCTION else 0
    if lang == "fr":
        function += len(re.findall(r"\b[ldnsjcqm]['’]", bare.lower()))
    return n, top / n, *grams, different / n, function / n, links / len(unit), len(SEPARATOR.findall(unit.strip())) / n, bool(ENDS.search(unit))


def is_stuffed(unit: str, f: tuple, limits: dict[str, float]) -> bool:
    """Whether the unit forms no sentence: links or tags, a list by separators, or terms repeated beyond its language's limits."""
    n, top, pairs, triples, quads, distinct, function, links, separators, ends = f
    if links > limits["links"]:
        return True
    items = [x for x in SEPARATOR.split(unit) if x and x.strip()]
    if len(items) >= 5 and n:
        size = n / len(items)
        if (size <= 4.5 or (size <= 6 and function <= 0.05 and not ends)) and (not ends or function <= limits["function"]) and separators >= limits["separators"] and (function < max(0.12, limits["function"] + 0.05)):
            return True
    if links >= 0.3 and n <= 2 * max(1, len(URL.findall(unit)) + len(TAG.findall(unit))):
        return True
    if n >= 8 and distinct < limits["distinct"] and function < 0.15 and (top > limits["top"] or pairs > limits["pairs"] or triples > limits["triples"] or quads > limits["quads"]):
        return True
    return n >= 6 and top >= 0.4 and function < 0.1


def repeats(parts: list[str]) -> list[float]:
    """For each unit of a snippet: the share of its words in phrases of three that the whole snippet has three times or more; 1 if
    the unit itself is so frequent."""
    words = [WORD.findall(u.lower()) for u in parts]
    if sum(map(len, words)) < 6:
        return [0.0] * len(parts)
    same = Counter(map(tuple, words))
    phrases = Counter(p for w in words for p in zip(w, w[1:], w[2:]))  # noqa: B905
    out = []
    for w in words:
        inside: set[int] = set()
        for i, p in enumerate(zip(w, w[1:], w[2:])):  # noqa: B905
            if phrases[p] >= 3:
                inside.update((i, i + 1, i + 2))
        out.append(1.0 if w and same[tuple(w)] >= 3 else len(inside) / max(1, len(w)))
    return out


def duplicates(parts: list[str]) -> list[bool]:
    """For each unit of a snippet, whether it repeats an earlier one word for word."""
    seen: set[str] = set()
    out = []
    for u in parts:
        k = " ".join(u.lower().split())
        out.append(k in seen)
        seen.add(k)
    return out


def keyword_repeats(keywords: str) -> int:
    """How often the most frequent keyword occurs."""
    terms = [" ".join(t.lower().split()) for t in KEYWORDS.split(keywords)]
    counts = Counter(t for t in terms if t)
    return max(counts.values(), default=0)


UNITS = (
    "id long, lang string, unit string, chars int, words int, top double, pairs double, triples double, quads double, distinct double, function double, links double, "
    "separators double, ends boolean, again double, copies double"
)


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    norm = normalizer(form_table())
    names = [c.split()[0] for c in UNITS.split(", ")]
    for pdf in batches:
        out = []
        for k, s in zip(pdf["id"], pdf["snippet"], strict=True):
            if not isinstance(s, str) or not s.strip():
                continue
            text = PLACEHOLDER.sub("x", norm.scan(s)[1] if SUSPECT.search(s) else s)
            lang = tongue(text)
            parts = units(text)
            twice = duplicates(parts)
            copies = sum(len(u) for u, d in zip(parts, twice, strict=True) if d) / max(1, sum(map(len, parts)))
            for u, again in zip(parts, repeats(parts), strict=True):
                out.append((k, lang, u, len(u), *features(u, lang), again, copies))
        frame = pd.DataFrame(out, columns=names)
        yield frame.astype({"id": "int64", "chars": "int32", "words": "int32", "ends": bool}) if len(out) else frame.astype({"id": "int64"})


#: What is taken as the limit: (quantile of the sentences, added to it, least, most, limit where there are too few sentences).
QUANTILES = {
    "top": (0.995, 0.0, 0.25, 1.0, 0.34), "pairs": (0.995, 0.0, 0.25, 1.0, 0.25), "triples": (0.995, 0.0, 0.2, 1.0, 0.2), "quads": (0.995, 0.0, 0.15, 1.0, 0.15), "distinct": (0.005, 0.0, 0.0, 0.75, 0.7),
    "function": (0.02, 0.0, 0.0, 1.0, 0.0), "links": (0.999, 0.1, 0.4, 0.6, 0.5), "separators": (0.995, 0.0, 0.1, 0.2, 0.15), "again": (0.995, 0.0, 0.5, 0.8, 0.5), "copies": (0.995, 0.0, 0.5, 0.8, 0.5),
}
BASE_LIMITS = {k: v[4] for k, v in QUANTILES.items()}


def limits_by_language(found: DataFrame) -> DataFrame:
    """Quantiles of each language from the units that end like sentences, and of all together as language '*'."""
    sentences = found.filter("ends and words >= 6").select("lang", *QUANTILES)
    both = sentences.unionByName(sentences.withColumn("lang", F.lit("*")))
    plain = F.col("links") < 0.2
    value = lambda k: F.col(k) if k == "links" else F.when(plain, F.col(k))
    return both.groupBy("lang").agg(F.count("*").alias("n"), *(F.percentile_approx(value(k), q).alias(k) for k, (q, *_) in QUANTILES.items()))


def _limits(found: DataFrame) -> dict[str, dict[str, float]]:
    """The limits as a dictionary; one row per known language, so its size is bounded by the list above."""
    rows = {r["lang"]: r.asDict() for r in limits_by_language(found).collect()}
    out = {}
    for lang in [*_FUNCTION, "", "*"]:
        r = rows.get(lang)
        if not r or r["n"] < MIN_UNITS:
            r = rows.get("*")
        if not r or r["n"] < MIN_UNITS:
            out[lang] = dict(BASE_LIMITS)
        else:
            out[lang] = {k: min(most, max(least, (BASE_LIMITS[k] if r[k] is None else r[k]) + more)) for k, (_, more, least, most, _) in QUANTILES.items()}
    return out


def stuffing(df: DataFrame, key: str = "id", share: float = 0.5, max_term: int = MAX_TERM) -> DataFrame:
    """(id, stuffed: share of the snippet's characters that form no sentences, term: most frequent keyword's count, spam)."""
    df = df.filter(F.col(key).isNotNull())
    found = checkpointed(df.select(F.col(key).alias("id"), "snippet").mapInPandas(_units, UNITS))
    limits = _limits(found)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = pdf[list(FEATURES)].itertuples(index=False, name=None)
            own = [limits.get(lang, limits["*"]) for lang in pdf["lang"]]
            bad = [c > x["copies"] or again > x["again"] or is_stuffed(u, f, x) for u, x, f, again, c in zip(pdf["unit"], own, rows, pdf["again"], pdf["copies"], strict=True)]
            yield pd.DataFrame({"id": pdf["id"], "chars": pdf["chars"], "bad": pdf["chars"] * pd.Series(bad, dtype="int32", index=pdf.index)})

    shares = found.mapInPandas(judge, "id long, chars long, bad long").groupBy("id").agg((F.sum("bad") / F.sum("chars")).alias("stuffed"))

    def terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        norm = normalizer(form_table())
        for pdf in batches:
            n = [keyword_repeats(norm.scan(k)[1]) if isinstance(k, str) and k else 0 for k in pdf["keywords"]]
            yield pd.DataFrame({"id": pdf["id"], "term": pd.Series(n, dtype="int32", index=pdf.index)})

    counted = df.select(F.col(key).alias("id"), "keywords").mapInPandas(terms, "id long, term int").groupBy("id").agg(F.max("term").alias("term"))
    return counted.join(shares, "id", "left").select("id", F.coalesce("stuffed", F.lit(0.0)).alias("stuffed"), "term", ((F.coalesce("stuffed", F.lit(0.0)) > share) | (F.col("term") >= max_term)).alias("spam"))
