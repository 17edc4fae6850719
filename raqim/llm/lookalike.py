"""Problem 4: text that looks the same but is made of other characters.

``form_table`` builds transitive look-alike classes by union-find over code points *and* strings: forms and the strings they
show (an Arabic ligature is equivalent to two letters), decomposed and composed letters, and letters that look alike across
scripts and languages, so a class may hold the plain letters of several scripts.  The representative of a class is chosen for
each writing (Latin, Cyrillic, Greek, Armenian letters; Arabic letters in Arabic and in Persian texts) by corpus frequency among
its plain members there.  ``Normalizer`` rewrites greedily, leftmost-longest, with a multi-pattern (Aho-Corasick) automaton
what means the same everywhere; letters of the classes are rewritten word by word, by the word's script and the record's
language.  It repeats this until nothing changes, so the form of a form is itself.

Edge cases: rows without a key have no row here; a null or empty value has no marks and its form is itself; of equally frequent plain members the
first of the fixed list represents the class; texts of any length are processed whole.
"""

from __future__ import annotations

import re
import sys
import unicodedata as U
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters that look like a Latin letter, as pairs (foreign, Latin).
LATIN_LOOKALIKES = (
    "аa еe оo рp сc уy хx іi јj ѕs ԁd һh ԛq ԝw А A В B Е E К K М M Н H О O Р P С C Т T У Y Х X І I Ј J Ѕ S Ԛ Q Ԝ W "
    "οo αa νv ιi ρp υu χx κk ϲc ϳj Α A Β B Ε E Ζ Z Η H Ι I Κ K Μ M Ν N Ο O Ρ P Τ T Υ Y Χ X Ϲ C Ϳ J "
    "օo սu հh ոn ցg զq Օ O Ս U ɡg ɑa ɩi"
)
#: Letters of the Arabic script that look alike inside a word; the first is Arabic's own, the second Persian's.
ARABIC_LOOKALIKES = (("ك", "ک", "ڪ"), ("ي", "ی"), ("ه", "ه", "ہ", "ھ", "ە"))
PERSIAN_ONLY = re.compile("[گپچژ]")
#: Compatibility decompositions that are forms of a letter; superscripts, fractions and signs are not.
FORM_TAGS = {"<wide>", "<small>", "<vertical>", "<narrow>", "<initial>", "<medial>", "<final>", "<isolated>", "<font>", "<circle>", "<square>"}
ZWNJ, ZWJ, VS16 = chr(0x200C), chr(0x200D), chr(0xFE0F)


def _characters(*ranges: int | tuple[int, int]) -> str:
    return "".join(chr(x) for r in ranges for x in (range(r[0], r[1] + 1) if isinstance(r, tuple) else (r,)))


INVISIBLE = _characters(0xAD, 0x34F, 0x61C, (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), 0xFEFF, (0xFFF9, 0xFFFB))
SPACES = _characters(9, 11, 12, 0x85, 0xA0, 0x1680, (0x2000, 0x200A), 0x202F, 0x205F, 0x3000)
JOINERS = ZWNJ + ZWJ
#: Greek, Cyrillic and Armenian letters, which decide by their word; combining marks, styled and presentation forms.
_RANGES = ((0x300, 0x3FF), (0x400, 0x58F), (0x653, 0x655), (0x1100, 0x11FF), (0x1F00, 0x1FFF), (0x20D0, 0x20FF), (0x2102, 0x214F), (0x2460, 0x24FF), (0x3099, 0x309A), (0x3200, 0x33FF), (0xF900, 0xFDFF), (0xFE10, 0xFE19), (0xFE20, 0xFE6F), (0xFE70, 0xFFEF), (0x10000, 0x1F2FF), (0x1FBF0, 0x1FBF9), (0x2F800, 0x2FA1F))


@lru_cache(maxsize=1)
def _edges() -> tuple[tuple[str, str], ...]:
    """(other form, its plain string), from the Unicode data that Python carries: forms, decomposed letters and letters
    stored twice."""
    out = []
    for cp in range(0x80, 0x30000):
        c = chr(cp)
        d = U.decomposition(c)
        if not d:
            continue
        if d[0] == "<":
            ligature = 0xFB00 <= cp <= 0xFB4F or 0xFB50 <= cp <= 0xFDFF or 0xFE70 <= cp <= 0xFEFF
            if d.split()[0] in FORM_TAGS or (ligature and d.startswith("<compat>")):
                plain = U.normalize("NFKC", c)
                if plain.strip() and plain != c and not (ligature and plain[0] == " "):
                    out.append((c, plain))
        elif (n := U.normalize("NFC", c)) != c:
            out.append((c, n))
        elif len(n := U.normalize("NFD", c)) > 1:
            out.append((n, c))
            if len(d.split()) == 2 and len(n) > 2:  # partly composed, as é + a second mark
                out.append(("".join(chr(int(x, 16)) for x in d.split()), c))
    return tuple(out)


ODD_ASCII, ARABIC, LATIN = re.compile("[\t\x0b\x0c]"), re.compile("[ء-غف-ي]"), re.compile("[A-Za-zÀ-ɏ]")


class _Gate:
    """Finds what must be looked at; any other text is in its consistent form already.  Besides single characters these are
    Latin letters between Arabic ones and the reverse."""

    def __init__(self, extra: str) -> None:
        all_ = re.escape(INVISIBLE + SPACES + extra) + "".join(f"{chr(a)}-{chr(b)}" for a, b in _RANGES)
        self.single = re.compile(f"[{all_}]")
        #: a run of such characters with the one before it; every rule's string is such a run
        self.part = re.compile(f"[^{all_}]?[{all_}]+", re.DOTALL)
        self.inside = re.compile("[ء-غف-ي][A-Za-zÀ-ɏ]+[ء-غف-ي]|[A-Za-zÀ-ɏ][ء-غف-ي]+[A-Za-zÀ-ɏ]")

    def search(self, text: str) -> re.Match | None:
        if text.isascii() and not ODD_ASCII.search(text):
            return None
        return self.single.search(text) or (self.inside.search(text) if ARABIC.search(text) and LATIN.search(text) else None)


EXTRA = "".join(x for row in ARABIC_LOOKALIKES for x in row[1:] if x != row[0]) + "ۀɡɑɩ" + "".join(sorted({c for form, _ in _edges() for c in form[1:] or form} - {c for a, b in _RANGES for c in map(chr, range(a, b + 1))}))
SUSPECT = _Gate(EXTRA)
MARK = f"{chr(0x300)}-{chr(0x36F)}{chr(0x64B)}-{chr(0x65F)}{chr(0x670)}{ZWNJ}{ZWJ}"
WORD = re.compile(rf"[^\W_]+(?:[{MARK}]+[^\W_]*)*")
#: A letter with combining marks in any order, and letters of decomposed Korean syllables.
LOOSE = re.compile(f"[^\\W_][{chr(0x300)}-{chr(0x36F)}]+|[{chr(0x1100)}-{chr(0x11FF)}]+")
FA_WORDS = {"در", "را", "به", "از", "که", "این", "با", "های", "می", "است", "برای", "یک", "شد", "ها", "هم", "گفت"}
AR_WORDS = {"في", "من", "على", "إلى", "عن", "قد", "كما", "هذا", "ما", "لا", "أن", "خلال", "بعد", "قبل", "منذ", "كل", "عند", "حتى", "كيف", "لماذا"}


class UnionFind:
    """Disjoint sets over hashable nodes with path halving."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        p = self.parent
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[b] = a


def _pairs() -> list[tuple[str, str]]:
    """The fixed pairs: a token of two letters is a pair, capitals stand as two tokens."""
    out, tokens = [], iter(LATIN_LOOKALIKES.split())
    for t in tokens:
        out.append((t[0], t[1]) if len(t) == 2 else (t, next(tokens)))
    return out


class Forms(dict):
    """Rewriting rules {string: representative} that hold everywhere, and ``words``: {writing: {member: representative}} for letters
    that are decided by their word."""

    words: dict[str, dict[str, str]]


def form_table(counts: dict[str, dict[str, int]] | None = None) -> Forms:
    """The rules of all classes.  ``counts``: how often each character occurs in Arabic and in Persian values ('ar', 'fa'), as
    ``character_counts`` gives them; its size is bounded by the number of code points.  A form, a decomposed string or an invisible
    character is never the representative, however frequent."""
    counts = counts or {}
    sets, other = UnionFind(), {}
    for form, plain in _edges():
        sets.union(plain, form)
        other[form] = plain
    for foreign, latin in _pairs():
        sets.union(latin, foreign)
    for row in ARABIC_LOOKALIKES:
        for x in row[1:]:
            sets.union(row[0], x)
    members: dict[str, list[str]] = {}
    for x in list(sets.parent):
        members.setdefault(sets.find(x), []).append(x)
    listed = {x: i for i, x in enumerate([*(b for _, b in _pairs()), *(a for a, _ in _pairs()), *(x for row in ARABIC_LOOKALIKES for x in row)])}
    rules, words = Forms(), {w: {} for w in ("L", "C", "G", "H", "ar", "fa")}
    for group in members.values():
        plain = [x for x in group if x not in other]
        for x in group:  # what a form shows is plain already, whatever class that belongs to
            if x in other:
                rules[x] = other[x]
        if len(plain) < 2:
            continue
        for writing, table in words.items():
            own = [x for x in plain if _script(x) == (writing if len(writing) == 1 else "A")]
            if not own:
                continue
            if writing in ("ar", "fa"):
                first = {row["ar fa".split().index(writing)] for row in ARABIC_LOOKALIKES}
                seen = counts.get(writing, {})
            else:
                first, seen = set(), {x: sum(c.get(x, 0) for c in counts.values()) for x in own}
            best = max(own, key=lambda x: (seen.get(x, 0), x in first, -listed[x]))  # noqa: B023
            table.update((x, best) for x in plain if x != best)
    for c in INVISIBLE:
        rules[c] = ""
    for c in SPACES:
        rules[c] = " "
    while True:  # strings that hold other members
        again = {k: v for k, old in rules.items() if (v := "".join(rules.get(c, c) for c in old)) != old}
        if not again:
            break
        rules.update(again)
    rules.pop(VS16, None)
    rules.words = words
    return rules


def language(text: str) -> str:
    """``fa`` or ``ar`` for text in Arabic letters, by letters and function words that only one of them uses; else ''."""
    fa = sum(text.count(c) for c in "گپچژ") * 2
    ar = sum(text.count(c) for c in "يكةىأإ")
    for w in WORD.findall(text):
        if w in FA_WORDS or (ZWNJ in w.strip(ZWNJ) and w[0] > chr(0x600)):
            fa += 2
        if w in AR_WORDS or (w.startswith("ال") and len(w) > 3) or w.startswith(("لل", "وال", "بال")):
            ar += 2
    return "" if not fa and not ar else "fa" if fa > ar else "ar"


def _script(c: str) -> str:
    o = ord(c)
    if o < 0x2B0 or 0x1E00 <= o <= 0x1EFF:
        return "L" if c.isalpha() else ""
    if 0x370 <= o <= 0x3FF or 0x1F00 <= o <= 0x1FFF:
        return "G"
    if 0x400 <= o <= 0x52F:
        return "C"
    if 0x530 <= o <= 0x58F:
        return "H" if c.isalpha() else ""
    if 0x600 <= o <= 0x6FF or 0x750 <= o <= 0x77F:
        return "A" if c.isalpha() else ""
    return "O" if c.isalpha() else ""


class Normalizer:
    """The compiled rules.  ``marks`` are the kinds of other characters found: form, decomposed, invisible, space, foreign."""

    def __init__(self, rules: Forms) -> None:
        self.rules = rules
        self.auto = ahocorasick.Automaton()
        for k, v in rules.items():
            self.auto.add_word(k, (len(k), v))
        self.auto.make_automaton()
        self.words = rules.words
        #: letters that look like one of another script; a word of others is genuine
        self.alike = frozenset(self.words["L"]) | {x for x, y in self.words["C"].items() if _script(x) == "L"}
        #: of the Arabic script, letters that another one represents, by language
        self.arabic = {w: {x: y for x, y in self.words[w].items() if _script(x) == "A"} for w in ("ar", "fa")}
        for row in ARABIC_LOOKALIKES[2:]:  # Persian and Urdu texts keep their own letters
            for x in row:
                self.arabic["fa"].pop(x, None)
        latin = "".join(x for x in self.words["L"] if _script(x) == "L")
        turned = "".join(x for x in self.arabic["ar"] if not SUSPECT.single.search(x))
        #: what must be looked at under these rules: more than SUSPECT where frequency has turned a class of Arabic letters
        self.gate = _Gate(EXTRA + turned) if turned else SUSPECT
        base = f"{chr(0x370)}-{chr(0x3FF)}{chr(0x400)}-{chr(0x58F)}"
        self.other = re.compile(f"[{base}]")
        base += re.escape(latin)
        self.foreign = {w: re.compile(f"[{base}{''.join(self.arabic.get(w, ''))}{'ۀ' if w == 'ar' else ''}]") for w in ("ar", "fa", "")}

    def scan(self, text: str | None, lang: str | None = None) -> tuple[set[str], str | None]:
        """(kinds of marks, consistent form but for case)."""
        if not text or not self.gate.search(text):
            return set(), text
        marks: set[str] = set()
        while True:
            new = self._once(text, lang, marks)
            if new == text or not self.gate.search(new):
                return marks, new
            text = new

    def _once(self, text: str, lang: str | None, marks: set[str]) -> str:
        if lang is None:
            lang = language(text)
        out, last = [], 0
        for m in self.gate.part.finditer(text):  # where rules can apply; the automaton's work follows these parts only
            for end, (n, new) in self.auto.iter_long(m.group()):
                end += m.start()
                start = end - n + 1
                if text[start : end + 1] in JOINERS and self._needed(text, start, end, lang):
                    continue
                marks.add("invisible" if new == "" else "space" if new == " " else "decomposed" if n > 1 else "form")
                out += [text[last:start], new]
                last = end + 1
        if out:
            text = "".join(out) + text[last:]
        if LOOSE.search(text):
            whole = LOOSE.sub(lambda m: U.normalize("NFC", m.group()), text)
            if len(whole) < len(text):
                marks.add("decomposed")
            text = whole
        return self._words(text, lang, marks)

    @staticmethod
    def _needed(text: str, start: int, end: int, lang: str) -> bool:
        """A joiner inside an emoji, or between two letters of a Persian text."""
        a, b = text[start - 1 : start], text[end + 1 : end + 2]
        if not a or not b:
            return False
        if text[start] == ZWJ and (U.category(a) in ("So", "Sk") or a == VS16) and U.category(b) == "So":
            return True
        return lang == "fa" and text[start] == ZWNJ and _script(a) == "A" and _script(b) == "A"

    def _words(self, s: str, lang: str, marks: set[str]) -> str:
        look = self.foreign[lang]
        inside = ARABIC.search(s) is not None and LATIN.search(s) is not None and SUSPECT.inside.search(s) is not None
        if not inside and not look.search(s):
            return s
        s = self._rewritten(s, lambda w: self._mixed(w, lang), look, inside, marks)
        if not self.other.search(s):
            return s
        own, latin = set(), False  # the scripts of which the value holds genuine words
        for m in WORD.finditer(s):
            w = m.group()
            if self.other.search(w):
                k = {_script(c) for c in w} - {""}
                if len(k) == 1 and any(c not in self.alike for c in w if c.isalpha()):
                    own |= k
            elif not latin:
                latin = LATIN.match(w) is not None and not ARABIC.search(w)

        def whole(w: str) -> tuple[str, bool]:
            """A word of one other script that is all look-alikes, in a text that has Latin words and no genuine one of that script."""
            k = {_script(c) for c in w} - {""}
            if latin and len(k) == 1 and k <= {"C", "G", "H"} and not k & own and all(c in self.words["L"] for c in w if c.isalpha()):
                return self._to("L", w), True
            return w, False

        return self._rewritten(s, whole, self.other, False, marks)

    @staticmethod
    def _rewritten(s: str, judge, look: re.Pattern, all_: bool, marks: set[str]) -> str:
        """The text with the words that have something to look at (or all of them) as ``judge`` gives them."""
        out, last = [], 0
        for m in WORD.finditer(s):
            w = m.group()
            if not all_ and not look.search(w):
                continue
            new, foreign = judge(w)
            if foreign:
                marks.add("foreign")
            if new != w:
                out += [s[last : m.start()], new]
                last = m.end()
        return "".join(out) + s[last:] if out else s

    def _to(self, writing: str, word: str, scripts: str = "") -> str:
        """The word with members of classes as the writing has them (only those of the scripts named)."""
        table = self.words[writing]
        return "".join(table.get(c, c) if not scripts or _script(c) in scripts else c for c in word)

    def _mixed(self, w: str, lang: str) -> tuple[str, bool]:
        """(the word as its script has it, whether it holds a letter of another script or language)."""
        k = {_script(c) for c in w} - {""}
        new, foreign = w, False
        if k & {"C", "G", "H"} and len(k & {"L", "C", "G", "H"}) > 1:
            # the script of most letters that look like no other decides, a choice that rewriting does not change; Latin if none has more
            n = Counter(_script(c) for c in w if c not in self.alike)
            new, foreign = self._to(max("LCGH", key=lambda x: n[x]), w, "LCGH"), True
        elif k == {"L"} and any(c in self.words["L"] and _script(c) == "L" for c in w) and any(c.isascii() for c in w):
            new, foreign = self._to("L", w, "L"), True
        if "A" in k:
            foreign |= SUSPECT.inside.search(w) is not None
            table = self.arabic.get(lang, {})
            if lang == "ar" and PERSIAN_ONLY.search(w):
                table = {}
            if any(c in table for c in w):
                new, foreign = "".join(table.get(c, c) for c in new), True
            if lang == "ar" and "ۀ" in w:
                new, foreign = new.replace("ۀ", "هٔ"), True
        return new, foreign


@lru_cache(maxsize=4)
def _compiled(rules: tuple[tuple[str, str], ...], words: tuple[tuple[str, tuple[tuple[str, str], ...]], ...]) -> Normalizer:
    out = Forms(rules)
    out.words = {w: dict(t) for w, t in words}
    return Normalizer(out)


def normalizer(rules: Forms) -> Normalizer:
    """The compiled rules, once per Python worker."""
    return _compiled(tuple(rules.items()), tuple((w, tuple(t.items())) for w, t in rules.words.items()))


_ANY_MARK = re.compile(f"[{MARK}]")
_RUN = re.compile(r"[^\W_]+")


def plain_words(form: str | None) -> list[str]:
    """Words of a consistent form: runs of letters and digits; marks and joiners inside a word belong to it and are left out."""
    if not form:
        return []
    if not _ANY_MARK.search(form):
        return _RUN.findall(form)
    return [_ANY_MARK.sub("", w) for w in WORD.findall(form)]


def character_counts(df: DataFrame, columns: list[str]) -> dict[str, dict[str, int]]:
    """How often each character occurs in the columns, in values with letters that only Persian has ('fa') and in others ('ar');
    summed in Spark, bounded by the code points."""
    present = [c for c in columns if c in df.columns]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 0x110000), dtype=np.int64)
        for pdf in batches:
            for c in present:
                values = [x for x in pdf[c] if isinstance(x, str)]
                persian = [PERSIAN_ONLY.search(x) is not None for x in values]
                for group in (0, 1):
                    text = "".join(x for x, p in zip(values, persian, strict=True) if p == group)
                    if text:
                        part = np.bincount(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
                        total[group, : len(part)] += part
        group, cp = np.nonzero(total)
        yield pd.DataFrame({"fa": group == 1, "cp": cp.astype(np.int32), "n": total[group, cp]})

    rows = df.select(*present).mapInPandas(count, "fa boolean, cp int, n long").groupBy("fa", "cp").agg(F.sum("n").alias("n")).collect()
    out: dict[str, dict[str, int]] = {"ar": {}, "fa": {}}
    for r in rows:
        out["fa" if r["fa"] else "ar"][chr(r["cp"])] = r["n"]
    return out


FORMS_SCHEMA = T.StructType([T.StructField("field", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType())), T.StructField("form", T.StringType())])


def forms(df: DataFrame, key: str, fields: list[str], rules: Forms, context: list[str] | None = None, only_marked: bool = False) -> DataFrame:
    """One row per record and field: ``kinds`` of other characters (empty: none) and the value's consistent ``form``, lower-cased.
    The language of a record is told from the fields and ``context`` together."""
    columns = list(dict.fromkeys([*fields, *(context or [])]))
    key_type = df.schema[key].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = normalizer(rules)
        for pdf in batches:
            ids, fs, kinds, out = [], [], [], []
            values = [pdf[c].tolist() for c in columns]
            for i, k in enumerate(pdf[key].tolist()):
                lang = None
                for j, f in enumerate(fields):
                    v = values[j][i]
                    if not isinstance(v, str):
                        v = None
                    if v is None or not n.gate.search(v):
                        if only_marked:
                            continue
                        marks, form = (), v
                    else:
                        if lang is None:
                            lang = language("\n".join(x[i] for x in values if isinstance(x[i], str)))
                        marks, form = n.scan(v, lang)
                        if only_marked and not marks:
                            continue
                    ids.append(k)
                    fs.append(f)
                    kinds.append(sorted(marks))
                    out.append(form.lower() if form else form)
            yield pd.DataFrame({key: pd.Series(ids, dtype=pdf[key].dtype), "field": pd.Series(fs, dtype=object), "kinds": pd.Series(kinds, dtype=object), "form": pd.Series(out, dtype=object)})

    schema = T.StructType([T.StructField(key, key_type), *FORMS_SCHEMA.fields])
    return df.filter(F.col(key).isNotNull()).select(key, *columns).mapInPandas(run, schema)


def marked(df: DataFrame, key: str = "id", fields: tuple[str, ...] = ("title", "snippet"), context: tuple[str, ...] = ("description",)) -> DataFrame:
    """The values that hold other characters, with the kinds and the consistent form."""
    rules = form_table(character_counts(df, [*fields]))
    return forms(df, key, list(fields), rules, [c for c in context if c in df.columns], only_marked=True)
