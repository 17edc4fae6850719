"""Problem 3: values cut off by a field's limit.

Storage limits hide in other units than characters, so each value's length is taken under several encodings (characters,
UTF-8 bytes, UTF-16 units, HTML-escaped, JSON-escaped, line breaks as CR LF, and combinations) and counted by source, field
and encoding, and by field and encoding over all sources; lengths at which values without an end stop pile up are the limits
(``site_limits``, ``limits``).  A source with too few values for limits of its own has those of the field.

Endings are then inspected.  A cut mark or note, a broken character, entity, tag or escape decides at once.  A value that
ends without a stop is compared with the corpus: its last sentence is reduced to a template of its script's most
frequent words, and the templates of *all* sentences say whether text that begins like this usually goes on (cut) or ends
here (a headline, a notice).  A last word that is nowhere a whole word is a cut word.  Where neither tells, a limit does.
Templates, last words and recurring lines are counted over different values, so copies of a value are no evidence about it.

Edge cases: rows without a key are left out; null and empty values are not cut; values of repeated rows are judged alike; lines that recur through a site,
lists, links, spam (problem 2) and template residue (problem 5) are not cut on account of how they end.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from raqim.llm.hosts import site
from raqim.llm.lookalike import INVISIBLE, SPACES, SUSPECT, form_table, normalizer
from raqim.llm.residue import MARKS, MESSAGES, NAME, PATH, WHOLE, _contexts, is_empty_value, is_filler, trailing_empty
from raqim.llm.site_lines import line_key
from raqim.llm.stuffing import BASE_LIMITS, SEPARATOR, features, is_stuffed, tongue, units
from raqim.session import checkpointed

BREAK = re.compile(r"\r\n|\n|\r")
STOP = re.compile(r"[.!?؟。！？]['\"”»’)\]]*$")
STOPS = re.compile(r"[.!?؟]['\"”»’)\]]*\s")
SENTENCE = re.compile(r"(?<=[.!?؟])['\"”»’)\]]*\s+")
WORD = re.compile(r"[^\W_]+(?:['’ً-ْ][^\W_]+)*")
#: Notes that editors and programs put where they cut.
NOTE = r"(?:اقرأ المزيد|المزيد|إقرأ المزيد|تابع القراءة|تابع|للمزيد|يتبع|التتمة|البقية|read more|continue reading|continued|more|cont\.?|to be continued|see more|show more|lire la suite|la suite|suite|à suivre|voir plus|plus|leia mais|continua|mehr|далее|читать далее|læs mere|ادامه|ادامه مطلب)"
MARK = re.compile(rf"(?:…|\.{{2,}}|\[\s*(?:…|\.{{2,}})\s*\]|\(\s*(?:…|\.{{2,}})\s*\)|\[{NOTE}\]|\({NOTE}\))\s*[\[(«»>→]*\s*(?:{NOTE})?\s*[\])»>→.]*$|(?:…|\.{{2,}})\s*[\[(]?{NOTE}[\])]?$", re.IGNORECASE)
TAG = re.compile(r"<(?:[A-Za-z/!][^<>]*)?$")
ENTITY = re.compile(r"&(#(?:x[0-9a-fA-F]*|\d*)|[A-Za-z][A-Za-z0-9]*)?$")
ESCAPE = re.compile(r"\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?$")
PERCENT = re.compile(r"((?:%[0-9A-Fa-f]{2})+)(%[0-9A-Fa-f]?)?$")
_ENTITY_STARTS = frozenset(n.rstrip(";")[:i] for n in ("amp", "lt", "gt", "quot", "apos", "nbsp", "laquo", "raquo", "hellip", "mdash", "ndash", "rsquo", "lsquo", "ldquo", "rdquo", "copy", "reg", "eacute", "egrave", "agrave", "ccedil", "ecirc", "bull", "middot", "zwnj", "zwj", "lrm", "rlm", "shy") for i in range(1, len(n) + 1))
EDGE = INVISIBLE + SPACES + " \r\n"
TRAIL = re.compile("[" + re.escape(EDGE) + "☀-➿️‍\U0001f000-\U0001faff]+$".replace("️", chr(0xFE0F)).replace("‍", chr(0x200D)))
#: Words of a template by level, and raw words at its start; the last figure bounds the words kept of each language.
FINE, COARSE, KNOWN = (200, 2), (100, 1), 2000
DIGITS = re.compile(r"\d+$")
#: Template hashes that a worker holds before it counts them.
FLUSH = 4_000_000
#: Templates in a row.
PACKED = 8192
LISTED = re.compile(r"[|/·•>,،;#»]|\s[-–—]\s|\s{2,}")
LINKED = re.compile(r"://|www\.|[a-z]\.[a-z]")
ENCODINGS = ("characters", "utf8", "utf16", "html", "json", "crlf", "utf8_crlf", "html_utf8")
#: A limit: so many open values there, so many times the mean within 12 of it.
LEAST_PILE, PILE = 8, 3.0
#: A source's own limit holds at least this share of its open values of the field.
SITE_SHARE = 0.04
#: Headlines of one make pile up at shorter lengths (twice that in bytes); there, a limit must also be the greatest length of its
#: source's open values.
HEADLINE = 80
BYTES = ("utf8", "utf8_crlf", "html_utf8")
#: A last line is the site's own if it follows so many different texts.
OWN_LINE = 3


_ARABIC = re.compile("[؀-ۿ]{2}")


def script(text: str) -> str:
    """The group whose words are ranked together: Arabic letters or others."""
    return "A" if _ARABIC.search(text) else "L"


_CLOSING = frozenset(".!?؟。！？'\"”»’)]")


def ends_sentence(text: str) -> bool:
    """A stop at the end, with or without closing marks."""
    return text[-1:] in _CLOSING and text != "" and STOP.search(text) is not None


def lengths(value: str) -> list[int]:
    """The value's length under each of ENCODINGS."""
    crlf = re.sub(r"\r\n|\n|\r", "\r\n", value)
    escaped = html.escape(value)
    safe = value.encode("utf-8", "replace")
    return [
        len(value), len(safe), len(value.encode("utf-16-le", "surrogatepass")) // 2, len(escaped), len(json.dumps(value, ensure_ascii=False)) - 2,
        len(crlf), len(safe) + len(crlf) - len(value), len(safe) + len(escaped) - len(value),
    ]


#: The encodings by the unit they count, characters or bytes.
UNITS_OF = tuple([e for e, x in enumerate(ENCODINGS) if (x in BYTES) == b] for b in (False, True))


def coded(lens: list[int]) -> list[int]:
    """The different lengths of a value by unit, each as unit * 2**40 + (bits of the encodings that give it) * 2**32 + length."""
    out: dict[int, int] = {}
    for unit, own in enumerate(UNITS_OF):
        for e in own:
            k = unit << 40 | lens[e]
            out[k] = out.get(k, 0) | 1 << e
    return [k | bits << 32 for k, bits in out.items()]


def mark_of(tail: str) -> str:
    """What shows a cut at the end of the text: mark, character, tag, entity, escape; '' if nothing does."""
    if not tail:
        return ""
    last = tail[-1]
    if last == chr(0xFFFD) or 0xD800 <= ord(last) <= 0xDFFF:
        return "character"
    near = tail
    if ("…" in near or ".." in near or last in "])") and MARK.search(near):
        return "mark"
    if "<" in near and (m := TAG.search(near)) and (m.start() == 0 or not near[m.start() - 1].isdigit() or len(m.group()) > 1) and not m.group().startswith("<?"):
        return "tag"
    if "&" in near and (m := ENTITY.search(near)):
        name = m.group(1) or ""
        if name.startswith("#") or (name in _ENTITY_STARTS and name) or (not name and m.start() and not near[m.start() - 1].isspace()):
            return "entity"
    if "\\" in near and ESCAPE.search(near):
        return "escape"
    if "%" in near and (m := PERCENT.search(near)):
        if m.group(2):
            return "escape"
        try:
            bytes.fromhex(m.group(1).replace("%", "")).decode()
        except ValueError:
            return "escape"
    return ""


def _template_hashes(ranks: np.ndarray, first: np.ndarray, group: np.ndarray, level: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each sentence's template, sentence of each of its proper prefixes, their hashes), for all sentences at once.  ``ranks`` are the
    words' ranks, sentence by sentence; ``first`` is where each begins.  A template keeps the words of low rank and known ones
    among the first; a run of others is one gap."""
    most, raw = level
    n = np.diff(np.append(first, len(ranks)))
    at = np.arange(len(ranks)) - np.repeat(first, n)
    gap = (ranks >= most) & ~((at < raw) & (ranks < KNOWN))
    follows = np.zeros(len(ranks), dtype=bool)
    follows[1:] = gap[1:] & gap[:-1]
    keep = ~(follows & (at > 0))
    tokens = np.where(gap, 0, ranks + 1)[keep].astype(np.uint64)
    sizes = np.add.reduceat(keep.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    starts = np.cumsum(sizes) - sizes
    h = group.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(raw)
    owners, prefixes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    with np.errstate(over="ignore"):
        for i in range(int(sizes.max(initial=0))):
            live = np.nonzero(sizes > i)[0]
            if i:
                owners.append(live)
                prefixes.append(h[live])
            x = (h[live] ^ tokens[starts[live] + i]) * np.uint64(0x9E3779B97F4A7C15)
            h[live] = x ^ (x >> np.uint64(29))
    return h.view(np.int64), np.concatenate(owners), np.concatenate(prefixes).view(np.int64)


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _count_words(fields: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """How often each word stands anywhere but at the end of its value."""
        counts: dict[str, Counter] = {}
        for pdf in batches:
            for f in fields:
                for v in pdf[f]:
                    if isinstance(v, str) and v:
                        words = WORD.findall(v.lower())
                        if words:
                            if v[-1].isalnum():
                                words.pop()
                            counts.setdefault(script(v), Counter()).update(words)
            if sum(map(len, counts.values())) > 200_000:
                yield _words_frame(counts)
                counts.clear()
        yield _words_frame(counts)

    return run


def _words_frame(counts: dict[str, Counter]) -> pd.DataFrame:
    rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
    return pd.DataFrame({"lang": pd.Series([r[0] for r in rows], dtype=object), "word": pd.Series([r[1] for r in rows], dtype=object), "n": pd.Series([r[2] for r in rows], dtype="int64")})


def word_counts(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(lang, word, n) over all values of the fields; the last word of a value counts only if something follows it."""
    return df.select(*fields).mapInPandas(_count_words(list(fields)), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


ROWS = "kind string, id long, site string, field string, cut string, fine long, coarse long, last string, line long, before long, value long, about string, lens array<long>, keys array<long>, counts array<long>"
_ARROW = pa.schema(
    [
        ("kind", pa.string()), ("id", pa.int64()), ("site", pa.string()), ("field", pa.string()), ("cut", pa.string()), ("fine", pa.int64()), ("coarse", pa.int64()), ("last", pa.string()),
        ("line", pa.int64()), ("before", pa.int64()), ("value", pa.int64()), ("about", pa.string()), ("lens", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ]
)


def _batch_of(n: int, **columns: list) -> pa.RecordBatch:
    """A batch of the row schema; columns that aren't given are null."""
    return pa.RecordBatch.from_arrays([(columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], type=f.type)) if f.name in columns else pa.nulls(n, type=f.type) for f in _ARROW], schema=_ARROW)


def _is_listing(text: str, tail: str) -> bool:
    """Spam, a list or links, judged on the whole value and on its last line."""
    words = text.split()
    if len(set(words)) > 0.6 * len(words) and len(LISTED.findall(text)) < 5 and text.count("\n") < 4 and not LINKED.search(text):
        return False
    lang = tongue(text)
    stuffed = [(len(u), is_stuffed(u, features(u, lang), BASE_LIMITS)) for u in units(text)]
    if sum(n for n, bad in stuffed if bad) > 0.5 * sum(n for n, _ in stuffed):
        return True
    if is_stuffed(tail, features(tail, lang), BASE_LIMITS):
        return True
    return bool(re.search(r"(?:https?://|www\.)\S+$", tail)) or (len(SEPARATOR.findall(tail)) >= 2 and bool(re.search(r"\s[|•·/]\s", tail)))


def _is_residue(text: str, own: tuple[str, ...]) -> tuple[bool, str]:
    """(residue of problem 5, its context where only the corpus can tell)."""
    if is_empty_value(text) or is_filler(text):
        return True, ""
    if MARKS.search(text):
        for line in BREAK.split(text):
            for c in _contexts(line):
                return (not c), c
    low = text.lower()
    if "/" in text or NAME.search(text):
        if any(o in low for o in own) or (PATH.search(low) and MESSAGES.search(low)):
            return True, ""
    if text.rstrip()[-1:] in "dlnNLaAtT])D" and trailing_empty(BREAK.split(text)[-1]):
        return True, ""
    return bool(WHOLE.search(re.sub(r"\d+", "0", low))), ""


def _template_rows(kept: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Counts of the template hashes that were kept, which are forgotten; many to a row, since the other columns are null."""
    for name, values in kept.items():
        if values:
            keys, n = np.unique(np.concatenate(values), return_counts=True)
            values.clear()
            if len(keys):
                cuts = np.append(np.arange(0, len(keys), PACKED), len(keys)).astype(np.int32)
                packed = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(x.astype(np.int64))) for x in (keys, n)]
                yield _batch_of(len(cuts) - 1, kind=pa.array([name] * (len(cuts) - 1)), keys=packed[0], counts=packed[1])


def _scan(fields: list[str], ranks: dict[str, dict[str, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = normalizer(form_table())
        words_of, rare = WORD.findall, repeat(KNOWN)
        kept: dict[str, list[np.ndarray]] = {"ends": [], "goes": []}
        seen: set[tuple[int, str]] = set()  # values counted, where rows are repeated
        for batch in batches:
            rows: list[tuple] = []
            flat: list[int] = []  # ranks of all words, sentence by sentence
            first: list[int] = []
            ended: list[bool] = []
            group: list[bool] = []
            counts: list[bool] = []  # whether the sentence's value is the one counted among its copies
            data = batch.to_pydict()
            for i, (k, s, path, counted) in enumerate(zip(data["id"], data["site__"], data["path__"], data["counted__"], strict=True)):
                own = tuple(o for o in (path, s) if len(o) > 4)
                for bit, f in enumerate(fields):
                    raw = data[f][i]
                    if not raw or (not raw[0].isalnum() and not raw.strip(EDGE)):
                        continue
                    v = norm.scan(raw)[1] if SUSPECT.search(raw) else raw
                    text = v if v[-1].isalnum() or v[-1] in _CLOSING else TRAIL.sub("", v)
                    lang = script(text)
                    known = ranks.get(lang) or ranks.get("*") or {}
                    lines = [x.strip() for x in BREAK.split(text) if x.strip()]
                    if not lines:
                        continue
                    cut = mark_of(text)
                    stopped = not cut and ends_sentence(text)
                    part: list[str] = []
                    count = bool(counted >> bit & 1) and (k, f) not in seen
                    if count:
                        seen.add((k, f))
                    elif stopped:
                        continue
                    get = known.get
                    arabic = lang == "A"
                    mine = -1
                    for j, line in enumerate(lines if count else lines[-1:], 0 if count else len(lines) - 1):
                        line = line.lower()
                        sentences = SENTENCE.split(line) if STOPS.search(line) else [line]
                        end = len(sentences) - 1
                        final = j == len(lines) - 1
                        for m, sentence in enumerate(sentences):
                            part = words_of(sentence)
                            if not part or (cut and final and m == end):
                                continue
                            mine = len(first)
                            first.append(len(flat))
                            flat.extend(map(get, part, rare))
                            ended.append(m < end or (stopped if final else ends_sentence(sentence)))  # sentences are split behind stops
                            group.append(arabic)
                            counts.append(count)
                    if stopped:
                        continue
                    tail = lines[-1]
                    residue, about = _is_residue(v, own) if f == "snippet" else (False, "")
                    if residue or _is_listing(text, tail):
                        continue
                    last = part[-1] if part and tail[-1:].isalnum() and not DIGITS.match(part[-1]) else ""
                    rows.append((k, s, f, cut, mine, mine, f"{lang} {last}" if last else None, _hash(f"{s}\n{line_key(tail)}"), _hash(line_key(" ".join(lines[:-1]))) if len(lines) > 1 else 0, _hash(f"{f}\n{raw}"), about or None, coded(lengths(raw))))
            levels = [_template_hashes(np.array(flat, dtype=np.int64), np.array(first, dtype=np.int64), np.array(group, dtype=np.int64), x) for x in (FINE, COARSE)]
            if rows:
                c = list(zip(*rows, strict=True))
                fine, coarse = ([int(h[0][i]) if i >= 0 else 0 for i in c[4]] for h in levels)
                yield _batch_of(len(rows), kind=["tail"] * len(rows), id=c[0], site=c[1], field=c[2], cut=c[3], fine=fine, coarse=coarse, last=c[6], line=c[7], before=c[8], value=c[9], about=c[10], lens=c[11])
            once = np.array(counts, dtype=bool)
            open_ends = ~np.array(ended, dtype=bool) & once
            for full, owners, prefixes in levels:
                kept["ends"].append(full[open_ends])
                kept["goes"].append(prefixes[once[owners]])
            if sum(map(len, kept["goes"])) > FLUSH:
                yield from _template_rows(kept)
        yield from _template_rows(kept)

    return run


def _scanned(df: DataFrame, key: str, fields: tuple[str, ...], counts: DataFrame) -> DataFrame:
    ranks: dict[str, dict[str, int]] = {}
    for group in ("A", "L"):  # the KNOWN most frequent words of each script; each partition gives its own most frequent
        top = counts.filter((F.col("lang") == group) & ~F.col("word").rlike("^[0-9]+$")).orderBy(F.desc("n"), "word").limit(KNOWN)
        ranks[group] = {r["word"]: i for i, r in enumerate(top.collect())}
    path = F.lower(F.regexp_extract("url", r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*?)/?(?:index\.html?)?(?:[?#].*)?$", 1))
    source = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.coalesce(site(F.col("url")), F.lit("")).alias("site__"), F.coalesce(path, F.lit("")).alias("path__"), *fields)
    # one record of each different value counts for all its copies; only hashes are grouped for it
    bits = F.array(*(F.struct(F.lit(1 << i).alias("bit"), F.xxhash64(f).alias("h")) for i, f in enumerate(fields)))
    values = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.explode(bits).alias("v")).select("id", "v.bit", "v.h")
    counted = values.groupBy("bit", "h").agg(F.min("id").alias("id")).groupBy("id").agg(F.bit_or("bit").alias("counted__"))
    source = source.join(counted.hint("shuffle_hash"), "id", "left").withColumn("counted__", F.coalesce("counted__", F.lit(0)))
    return checkpointed(source.mapInArrow(_scan(list(fields), ranks), ROWS))


def _length(code: Column) -> Column:
    return code.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def _under(code: Column, e: Column) -> Column:
    """Whether the length of a code is the value's under encoding e."""
    return F.getbit(F.shiftright(code, 32), e) == 1


_BY_ENCODING = [f"e{e}" for e in range(len(ENCODINGS))]


def lengths_of(open_: DataFrame) -> DataFrame:
    """(site, field, unit, length, n: values that have it under any encoding of the unit, e0 ...: by encoding), counted before the shuffle."""
    each = open_.select("site", "field", F.explode("lens").alias("code"))
    each = each.withColumns({"unit": F.shiftright("code", 40).cast("int"), "length": _length(F.col("code"))})
    return each.groupBy("site", "field", "unit", "length").agg(F.count("*").alias("n"), *(F.sum(_under(F.col("code"), F.lit(e)).cast("int")).alias(c) for e, c in enumerate(_BY_ENCODING)))


def _high(counts: DataFrame) -> DataFrame:
    """A row per length and encoding that enough values have it under."""
    each = F.filter(F.array(*(F.struct(F.col(c).alias("open"), F.lit(e).alias("e")) for e, c in enumerate(_BY_ENCODING))), lambda x: x["open"] >= LEAST_PILE)
    return counts.filter(F.col("n") >= LEAST_PILE).withColumn("x", F.explode(each)).select("*", "x.open", "x.e").drop("x", "n", *_BY_ENCODING)


def _piled(counts: DataFrame, high: DataFrame, by: list[str]) -> DataFrame:
    """(by, e, length, open) of the lengths ``high`` at which so many more values lie than at their neighbours under the same encoding."""
    steps = [d for d in range(-12, 13) if abs(d) > 1]
    near = high.withColumnRenamed("length", "at").withColumn("length", F.explode(F.array([F.col("at") + d for d in steps]))).join(counts, [*by, "unit", "length"], "left")
    others = F.coalesce(F.get(F.array(*_BY_ENCODING), F.col("e")), F.lit(0))
    usual = near.groupBy(*by, "e", "at").agg(F.first("open").alias("open"), (F.sum(others) / len(steps)).alias("usual"))
    return usual.filter(F.col("open") > PILE * (F.col("usual") + 1)).select(*by, "e", F.col("at").alias("length"), "open")


def limits(counts: DataFrame) -> DataFrame:
    """(field, e: position in ENCODINGS, length, open): lengths at which open values of all sources pile up against their neighbours."""
    whole = counts.groupBy("field", "unit", "length").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in _BY_ENCODING))
    return _piled(whole, _high(whole).filter(F.col("length") >= HEADLINE * (F.col("unit") + 1)), ["field"])


def site_limits(open_: DataFrame, counts: DataFrame) -> DataFrame:
    """(site, field, e, length, open): the same by source, against all its open values of the field too."""
    greatest = [F.max(F.array_max(F.transform(F.filter("lens", lambda x: F.shiftright(x, 40) == unit), _length))).alias(f"m{unit}") for unit in (0, 1)]  # noqa: B023
    total = open_.groupBy("site", "field").agg(F.count("*").alias("all"), *greatest)
    longest = F.when(F.col("unit") == 0, F.col("m0")).otherwise(F.col("m1"))
    high = _high(counts).join(total, ["site", "field"])
    high = high.filter((F.col("open") >= SITE_SHARE * F.col("all")) & ((F.col("length") >= HEADLINE * (F.col("unit") + 1)) | (F.col("length") == longest)))
    return _piled(counts, high, ["site", "field"])


def truncated(df: DataFrame, key: str = "id", fields: tuple[str, ...] = ("snippet", "description"), extra: tuple[str, ...] = ("title",)) -> DataFrame:
    """(id, site, field, cut: what shows it, limit: the encoding and length of a storage limit that the value reaches, or null) of the
    values that were cut off."""
    return _judged(df, key, fields, extra)


def _judged(df: DataFrame, key: str, fields: tuple[str, ...], extra: tuple[str, ...]) -> DataFrame:
    counts = checkpointed(word_counts(df, (*fields, *(e for e in extra if e in df.columns))))
    scanned = _scanned(df, key, fields, counts)
    # open values are few beside the templates and read by many branches
    tails = checkpointed(scanned.filter("kind = 'tail'").select("id", "site", "field", "cut", "fine", "coarse", "last", "line", "before", "value", "about", "lens"))
    each = scanned.filter("kind in ('ends', 'goes')").select("kind", F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("counts").alias("n"))))
    templates = each.groupBy("key").agg(*(F.sum(F.when(F.col("kind") == x, F.col("n")).otherwise(0)).alias(x) for x in ("ends", "goes")))
    # the highest pile comes first, of equal ones the encoding that is named first
    in_order = lambda of, by, name: of.groupBy(*by).agg(F.sort_array(F.collect_set(F.struct((-F.col("open")).alias("pile"), "e", "length"))).alias(name))
    counted = checkpointed(lengths_of(tails))
    of_field = in_order(limits(counted), ["field"], "general")  # a row a field
    of_site = in_order(site_limits(tails, counted), ["site", "field"], "own")
    tails = tails.join(of_site, ["site", "field"], "left").join(of_field, "field", "left")
    none = F.array().cast("array<struct<pile:bigint,e:int,length:int>>")
    all_limits = F.concat(F.coalesce("own", none), F.coalesce("general", none))
    reached = F.filter(all_limits, lambda x: F.exists("lens", lambda c: _length(c).between(x["length"] - 1, x["length"]) & _under(c, x["e"])))
    name = F.concat(F.element_at(F.array(*map(F.lit, ENCODINGS)), F.get(reached, F.lit(0))["e"] + 1), F.lit(" "), F.get(reached, F.lit(0))["length"].cast("string"))
    tails = checkpointed(tails.withColumn("limit", F.when(F.size(reached) > 0, name)).drop("lens", "own", "general"))
    open_ = tails.filter("cut = ''")
    # the site's own recurring lines, as they stand at the end of values
    own = open_.groupBy("line").agg(F.countDistinct("before").alias("texts")).filter(F.col("texts") >= OWN_LINE).select("line", F.lit(True).alias("recurs"))
    words = counts.select(F.concat_ws(" ", "lang", "word").alias("last"), F.col("n").alias("whole"))
    pieces = open_.filter("last is not null").groupBy("last").agg(F.countDistinct("value").alias("open_ends")).join(words, "last", "left")
    # only templates that an open value asks for are kept; they are few beside all
    asked = open_.select(F.explode(F.array("fine", "coarse")).alias("key")).filter("key <> 0").distinct()
    templates = checkpointed(templates.join(asked.hint("shuffle_hash"), "key"))
    # a value without a last word or a sentence has keys of its own, so that such values don't meet in one task
    keyed = open_.withColumns({"last_": F.coalesce("last", F.col("id").cast("string")), "fine": F.when(F.col("fine") == 0, F.xxhash64("id")).otherwise(F.col("fine")), "coarse": F.when(F.col("coarse") == 0, F.xxhash64("id")).otherwise(F.col("coarse"))})
    judged = (
        keyed.join(templates.select(F.col("key").alias("fine"), F.col("ends").alias("e1"), F.col("goes").alias("g1")), "fine", "left")
        .join(templates.select(F.col("key").alias("coarse"), F.col("ends").alias("e2"), F.col("goes").alias("g2")), "coarse", "left")
        .join(pieces.withColumnRenamed("last", "last_"), "last_", "left").join(own, "line", "left")
    )
    zero = F.lit(0)
    # with all its copies, the value itself is one of the ends
    e1, g1, e2, g2 = (F.coalesce(c, zero) for c in ("e1", "g1", "e2", "g2"))
    limited = F.col("limit").isNotNull()
    # a cut word is nowhere whole (nor a habitual last word), or is a stump that open ends have more often than sentences do
    stump = (F.length(F.substring_index("last", " ", -1)) <= 4) & (F.col("open_ends") * 2 >= F.coalesce("whole", zero)) & (F.col("open_ends") >= 2)
    enough = e1 + g1 >= 5
    goes_on = F.when(enough, g1 > e1).otherwise(g2 > e2)
    ends_here = F.when(enough, e1 > 4 * g1).otherwise((e2 > 4 * g2) & (e2 >= 5))
    unknown = F.col("last").isNotNull() & (((F.coalesce("whole", zero) == 0) & (~ends_here | (F.col("open_ends") <= 2) | (F.length(F.substring_index("last", " ", -1)) <= 3))) | (stump & ~ends_here))
    cut = (
        F.when(F.coalesce("recurs", F.lit(False)) & ~limited, F.lit(None))
        .when(unknown, F.lit("word"))
        .when(goes_on, F.lit("sentence"))
        .when(limited & ~ends_here & ~F.coalesce("recurs", F.lit(False)), F.lit("limit"))
    )
    columns = ["id", "site", "field", "cut", "limit", "about", "value"]
    judged = judged.withColumn("cut", cut).filter("cut is not null").select(*columns)
    all_ = tails.filter("cut <> ''").select(*columns).union(judged)
    # placeholders with words on both sides are residue unless the same words surround them in record after record
    text_about = all_.filter("about is not null").groupBy("about").agg(F.countDistinct("value").alias("n")).filter("n >= 2").select("about")
    kept = all_.filter("about is null").union(all_.filter("about is not null").join(text_about, "about", "left_semi").select(*columns))
    return kept.select("id", "site", "field", "cut", "limit")


def report(df: DataFrame, key: str = "id", fields: tuple[str, ...] = ("snippet", "description"), extra: tuple[str, ...] = ("title",)) -> DataFrame:
    """(site, field, values, cut, share, at_limit, limit): how often each site cuts its values that aren't empty, how many of these reach a
    storage limit, and the limit that most of them reach."""
    found = truncated(df, key, fields, extra).groupBy("site", "field", "limit").agg(F.count("*").alias("n"))
    at = F.when(F.col("limit").isNotNull(), F.col("n"))
    found = found.groupBy("site", "field").agg(F.sum("n").alias("cut"), F.sum(at).alias("at_limit"), F.max(F.when(at.isNotNull(), F.struct("n", "limit"))).alias("most"))
    values = df.select(F.coalesce(site(F.col("url")), F.lit("")).alias("site"), F.explode(F.filter(F.array(*(F.when(F.length(F.trim(f)) > 0, F.lit(f)) for f in fields)), lambda x: x.isNotNull())).alias("field"))
    n = values.groupBy("site", "field").agg(F.count("*").alias("values"))
    cut = F.coalesce("cut", F.lit(0))
    return n.join(found, ["site", "field"], "left").select("site", "field", "values", cut.alias("cut"), (cut / F.col("values")).alias("share"), F.coalesce("at_limit", F.lit(0)).alias("at_limit"), F.col("most.limit").alias("limit"))
