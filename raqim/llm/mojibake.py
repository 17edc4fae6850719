"""Problem 9: text garbled by a wrong decoding, found and restored with a hidden Markov model.

The model has one clean state and one state for each encoding pair (the bytes' true encoding and the one they were read
with; twice for text garbled twice).  A state emits a character given the one before it.  The clean state's emissions are
counted on all lines of all documents but those that decode as garbled or that the model so far finds garbled, together
with a few built-in words of each language; the other states' emissions are those same lines sent through the pair's wrong decoding.  As that goes letter by
letter, it is done to the counts: neighbouring characters are counted by the pairs that their line can pass through and is
changed by, and what leaves the executors is a row for each state and two neighbours.  Viterbi labels all characters of
every document, many lines at a time in numpy; each labelled span gets its state's inverse transform, which must give text
that the clean state finds more likely.

Lines without any character that a garbling state could emit and clean text seldom holds (ASCII, Arabic letters and
ordinary typographic signs can't garble alone, unless Latin and Arabic letters meet in a word) have the clean path by
construction and are passed over.

Edge cases: rows without a key are left out; null and empty texts are not garbled; replacement signs and C1 control characters are garbled though nothing
restores them; a span whose inverse fails in part is restored as far as it goes; repeated rows are judged alike.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values: (true encoding, wrong encoding, times).
PAIRS = (
    ("utf-8", "cp1252", 1), ("utf-8", "latin-1", 1), ("utf-8", "cp1256", 1), ("utf-8", "cp1251", 1), ("utf-8", "cp437", 1), ("utf-8", "mac_roman", 1), ("utf-8", "cp850", 1), ("utf-8", "koi8-r", 1),
    ("utf-8", "cp1254", 1), ("utf-8", "iso8859-15", 1), ("utf-8", "iso8859-6", 1), ("utf-8", "iso8859-5", 1), ("utf-8", "cp1250", 1), ("utf-8", "cp1252", 2), ("utf-8", "latin-1", 2), ("cp1256", "cp1252", 1), ("cp1256", "latin-1", 1),
    ("iso8859-6", "latin-1", 1), ("iso8859-6", "cp1252", 1), ("cp1256", "mac_roman", 1), ("cp1256", "cp437", 1), ("cp1256", "cp1251", 1), ("cp1251", "cp1252", 1), ("cp1251", "koi8-r", 1), ("koi8-r", "cp1251", 1), ("koi8-r", "latin-1", 1),
    ("cp866", "cp1251", 1), ("cp1252", "mac_roman", 1), ("mac_roman", "cp1252", 1), ("cp1252", "cp437", 1), ("cp1252", "cp850", 1), ("cp437", "cp1252", 1), ("cp850", "cp1252", 1), ("cp1252", "cp1256", 1), ("cp1252", "cp1251", 1),
)
#: Built-in words, so that each language has a state even where the sample lacks it.
SEED = {
    "ar": "في من إلى على هذا هذه كان قال بعد قبل عند حتى كيف لماذا يمكن العربية المدينة الكتاب مدرسة جديدة سنة يوم أول مؤسسة رئيس، والعمل بين الناس ثم أيضا آخر ذلك شيء غير ظل ضوء صغير طريق خبز نص مجلة جميع حقوق محفوظة",
    "fa": "است این که را در به از با برای می شود گفت کتاب چراغ پژوهش ژرف گندم کشاورزی یک هر آن دربارهٔ",
    "fr": "été à la forêt où l'élève préfère ça déjà très même après être château hôtel île cœur naïf Noël août garçon français À Éva Ça d’été “ici” l’eau — déjà… ô où",
    "pt": "não são maçã coração informação é já três avó você português lições câmara pães São João edição à",
    "da": "øl på også både år grøn smørrebrød blå æble Århus Øster Åben køkken træer høns sæler",
    "ru": "и в на не что он она это как для города школы музыка книги лодки погода огороды выставку Журнал Группа Обзор письма мосты съезд ёлка эхо юг яма чай жизнь щит цена фильм",
    "de": "für über schön größer Straße Äpfel Öl Übung müssen weiß können",
    "es": "niño año señor corazón también más allá qué español ¿cómo? ¡sí! España mañana",
    "en": "it’s settled “quiet” a season — as planned… 20 °C – the café don’t isn’t “then” €5 £7 naïve",
}
ORDINARY = re.compile("[\\s\x20-\x7eء-غف-ٕ٠-٩،؛؟پچژکگی“”’‘…—–«»‌]+")
#: Ordinary characters of two scripts in one word, as cp1252 read as cp1256 leaves them.
MIXED = re.compile("[A-Za-z][ء-غف-ْ]|[ء-غف-ْ][A-Za-z]")
BREAK = re.compile(r"(\r\n|\n|\r)")
#: Cells of the Viterbi lattice (characters by lines) that are held at once; a longer line is a batch of its own.
CELLS = 1_600_000
#: Characters whose neighbours are counted at once; a longer text is counted by itself.
CHUNK = 1 << 20
#: Lines that are labelled at once, if they aren't longer than the cells allow.
ROWS = 2048
#: A table of at most so many cells is addressed directly, a larger one is sorted or searched.
DIRECT = 1 << 22
#: A line of ordinary characters alone is not judged; all such lines together weigh so much of the others (or of so many, if the
#: others are fewer), each at most as one.
USUAL_SHARE, USUAL_LINES = 0.4, 1500
#: How often the lines that the model finds garbled are taken out of its counts.
ROUNDS = 2
#: With fewer odd characters than this in a span, a single-byte pair must also leave the case of words whole.
FEW_ODD = 3
BAD = re.compile("[\x80-\x84\x86-\x9f�]")


def _plain(text: str) -> bool:
    """Whether the text can't be garbled: ordinary characters, and no Latin letter beside an Arabic one."""
    return ORDINARY.fullmatch(text) is not None and not MIXED.search(text)


def _decode(data: bytes, encoding: str, errors: str = "strict") -> str:
    """Bytes as the encoding reads them; those that a code page leaves open become control characters, as browsers do."""
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        if encoding.startswith("utf"):
            if errors == "strict":
                raise
            return data.decode(encoding, errors)
        return "".join(_table(encoding)[b] for b in data)


@lru_cache(maxsize=64)
def _table(encoding: str) -> tuple[str, ...]:
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return tuple(out)


@lru_cache(maxsize=64)
def _bytes_of(encoding: str) -> dict[str, int]:
    return {c: b for b, c in reversed(list(enumerate(_table(encoding))))}


@lru_cache(maxsize=64)
def _known(encoding: str) -> re.Pattern[str]:
    return re.compile(f"[{re.escape(''.join(sorted(_bytes_of(encoding))))}]+")


def garble(text: str, true: str, wrong: str, times: int = 1) -> str | None:
    """The text as the pair garbles it; None where the true encoding can't hold it."""
    for _ in range(times):
        try:
            data = text.encode(true)
        except UnicodeEncodeError:
            return None
        text = _decode(data, wrong)
    return text


def restore(text: str, true: str, wrong: str, times: int = 1) -> tuple[str, int]:
    """(the inverse transform, how many bytes of it failed); characters that the wrong encoding doesn't have stay as they are."""
    failed = 0
    for _ in range(times):
        try:  # mostly all of it has a place
            text = _decode(text.encode(wrong), true, "replace")
            failed += text.count(chr(0xFFFD))
            continue
        except UnicodeEncodeError:
            pass
        codes = _bytes_of(wrong)
        out, last = [], 0
        for run in _known(wrong).finditer(text):
            out += [text[last : run.start()], _decode(bytes(map(codes.__getitem__, run.group())), true, "replace")]
            last = run.end()
        out.append(text[last:])
        failed += sum(x.count(chr(0xFFFD)) for x in out)
        text = "".join(out)
    return text, failed


@lru_cache(maxsize=1)
def _undone() -> re.Pattern[str]:
    """Characters beyond ASCII that are, as some wrong encoding has them, the bytes of UTF-8 from end to end."""
    high = [(0x80, 0xBF)]
    forms = [[(0xC2, 0xDF)], [(0xE0, 0xE0), (0xA0, 0xBF)], [(0xE1, 0xEC), *high], [(0xED, 0xED), (0x80, 0x9F)], [(0xEE, 0xEF), *high], [(0xF0, 0xF0), (0x90, 0xBF), *high], [(0xF1, 0xF3), *high * 2], [(0xF4, 0xF4), (0x80, 0x8F), *high]]
    ways, leads = [], set()
    for wrong in dict.fromkeys(wrong for true, wrong, _ in PAIRS if true == "utf-8"):
        of: dict[int, list[str]] = {}
        for c, b in _bytes_of(wrong).items():
            of.setdefault(b, []).append(c)
        signs = lambda x, y, of=of: [c for b in range(x, y + 1) for c in of.get(b, ())]
        parts = [[signs(*x) for x in [*form, *high]] for form in forms]
        parts = [x for x in parts if all(x)]
        leads |= {c for x in parts for c in x[0]}
        ways.append("(?:" + "|".join("".join(f"[{re.escape(''.join(c))}]" for c in x) for x in parts) + ")+")
    return re.compile(rf"(?<![^\x00-\x7f])(?=[{re.escape(''.join(sorted(leads)))}])(?:{'|'.join(f'{x}(?![^\x00-\x7f])' for x in ways)})")


SPACE, USUAL, LETTER, HIGH, SIGN, BROKEN, ODD = (1 << i for i in range(7))


def _traits(c: str) -> int:
    """What decides, together with the rest of its line, whether a line looks garbled."""
    usual = ORDINARY.fullmatch(c) is not None
    odd = c > "\x7f" and not usual
    broken = BAD.match(c) is not None or odd and ("─" <= c <= "╿" or "░" <= c <= "▓")
    return SPACE * c.isspace() | USUAL * usual | LETTER * c.isalpha() | HIGH * (odd and c <= "\xff" and c >= "\xc0") | SIGN * (odd and not c.isalpha()) | BROKEN * broken | ODD * odd


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(different keys in order, the sum of n of each)"""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


class Tally:
    """How often a character follows another in lines that don't look garbled, by what the pairs do to the line.

    Characters are held as code points plus one, so that 0 is the start of a line; two neighbours are one number.  A line is of
    the kind that has a bit for each pair whose encodings can hold all of it and that changes it, and one for ordinary characters."""

    BITS = 21

    def __init__(self) -> None:
        self.code = np.zeros(0x110000, dtype=np.int32)
        self.points = np.zeros(1, dtype=np.int64)
        self.able, self.changed = np.zeros(1, dtype=np.uint64), np.zeros(1, dtype=np.uint64)
        self.traits = np.zeros(1, dtype=np.uint8)
        self.kinds: dict[int, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def _learn(self, points: np.ndarray) -> None:
        seen = np.zeros(len(self.code), dtype=bool)
        seen[points] = True
        new = np.flatnonzero(seen & (self.code == 0))
        if not len(new):
            return
        self.code[new] = np.arange(len(self.points), len(self.points) + len(new))
        able, changed = [], []
        for c in map(chr, new):
            forms = [garble(c, *pair) for pair in PAIRS]
            able.append(sum(1 << p for p, x in enumerate(forms) if x is not None))
            changed.append(sum(1 << p for p, x in enumerate(forms) if x is not None and x != c))
        self.points = np.r_[self.points, new + 1]
        self.able = np.r_[self.able, np.array(able, dtype=np.uint64)]
        self.changed = np.r_[self.changed, np.array(changed, dtype=np.uint64)]
        self.traits = np.r_[self.traits, np.array([_traits(chr(c)) for c in new], dtype=np.uint8)]

    def add(self, texts: Iterable[str], sure: bool = False) -> Tally:
        """Counts all lines of the texts, if sure those too that look garbled."""
        some, size = [], 0
        for t in texts:
            if some and size + len(t) > CHUNK:
                self._add("\n".join(some), sure)
                some, size = [], 0
            some.append(t)
            size += len(t) + 1
        if some:
            self._add("\n".join(some), sure)
        return self

    def taken(self, lines: list[str]) -> np.ndarray:
        """Which of the lines are counted; none is empty."""
        return self._judged("\n".join(lines), False)[-1] if lines else np.zeros(0, dtype=bool)

    def _judged(self, text: str, sure: bool) -> tuple[np.ndarray, ...]:
        """(characters but line breaks by code; start, length and common traits of each line, and whether it is counted)"""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self._learn(points)
        at = np.flatnonzero((points != 10) & (points != 13))
        if not len(at):
            return (at,) * 5
        c = self.code[points[at]]
        starts = np.flatnonzero(np.r_[True, np.diff(at) > 1])
        lengths = np.diff(np.r_[starts, len(c)])
        traits = self.traits[c]
        every, some = np.bitwise_and.reduceat(traits, starts), np.bitwise_or.reduceat(traits, starts)
        count = lambda trait: np.add.reduceat((traits & trait) > 0, starts, dtype=np.int64)
        wrong = (some & BROKEN) > 0
        wrong |= (count(HIGH) > 0.3 * count(LETTER)) | (count(SIGN) > np.maximum(3, 0.1 * lengths))
        for i in np.flatnonzero(~wrong & ((some & ODD) > 0)) if not sure else ():
            wrong[i] = _undone().search(text, at[starts[i]], at[starts[i]] + lengths[i]) is not None
        return c, starts, lengths, every, (sure | ~wrong | ((every & USUAL) > 0)) & ((every & SPACE) == 0)

    def _add(self, text: str, sure: bool) -> None:
        c, starts, lengths, every, taken = self._judged(text, sure)
        if not len(c):
            return
        kinds = np.bitwise_and.reduceat(self.able[c], starts) & np.bitwise_or.reduceat(self.changed[c], starts)
        kinds, kind = np.unique(kinds | ((every & USUAL) > 0).astype(np.uint64) << np.uint64(len(PAIRS)), return_inverse=True)
        before = np.r_[0, c[:-1]].astype(np.int64)
        before[starts] = 0
        m = len(self.points)
        mine = np.repeat(taken, lengths)
        two, kind = (before * m + c)[mine], np.repeat(kind, lengths)[mine]
        if m * m <= DIRECT:
            pairs = np.flatnonzero(np.bincount(two, minlength=m * m))
            place = np.zeros(m * m, dtype=np.int64)
            place[pairs] = np.arange(len(pairs))
            two = place[two]
        else:
            pairs, two = np.unique(two, return_inverse=True)
        keys = kind * len(pairs) + two
        if len(kinds) * len(pairs) <= DIRECT:
            n = np.bincount(keys)
            keys = np.flatnonzero(n)
            n = n[keys]
        else:
            keys, n = np.unique(keys, return_counts=True)
        if not len(keys):
            return
        numbers = np.array([self.kinds.setdefault(int(k), len(self.kinds)) for k in kinds], dtype=np.int64)
        kind, two = np.divmod(keys, len(pairs))
        two = pairs[two]
        self.parts.append((numbers[kind] << 2 * self.BITS | self.points[two // m] << self.BITS | self.points[two % m], n.astype(np.int64)))
        self.held += len(keys)
        if self.held > DIRECT:
            self._merge()
            self.held = 0

    def _merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate([x[i] for x in self.parts] or [np.zeros(0, np.int64)]) for i in (0, 1))
        self.parts = [_summed(keys, n)]
        return self.parts[0]

    def states(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(state, neighbours, how often in lines with others than ordinary characters and in lines of these alone) of the clean
        state and of each pair's, whose lines are those sent through the pair."""
        keys, n = self._merge()
        kind, two = keys >> 2 * self.BITS, keys & (1 << 2 * self.BITS) - 1
        masks = np.array(list(self.kinds), dtype=np.uint64)
        usual = (masks >> np.uint64(len(PAIRS))).astype(bool)[kind]
        n = np.stack([np.where(usual, 0, n), np.where(usual, n, 0)], axis=1)
        for p in range(len(PAIRS) + 1):
            own = slice(None) if p == 0 else ((masks >> np.uint64(p - 1)) & np.uint64(1)).astype(bool)[kind]
            t, k = _summed(two[own], n[own])
            if not len(t):
                continue
            if p:
                t, k = self._sent(t, k, PAIRS[p - 1])
            yield p, t, k

    def _sent(self, two: np.ndarray, n: np.ndarray, pair: tuple[str, str, int]) -> tuple[np.ndarray, np.ndarray]:
        """The counts of neighbours as the pair garbles them: between what two characters become, and within that."""
        before, after = two >> self.BITS, two & (1 << self.BITS) - 1
        single, k = _summed(after, n)
        forms = [garble(chr(c - 1), *pair) for c in single]
        first, last = (np.array([ord(x[i]) + 1 for x in forms], dtype=np.int64) for i in (0, -1))
        begun = np.where(before == 0, 0, last[np.searchsorted(single, before) % len(single)])  # a character before another was after one, or began the line
        inner = [(ord(a) + 1 << self.BITS | ord(b) + 1, i) for i, x in enumerate(forms) for a, b in zip(x, x[1:])]  # noqa: B905
        inside = np.array(inner, dtype=np.int64).reshape(-1, 2)
        return _summed(np.r_[begun << self.BITS | first[np.searchsorted(single, after)], inside[:, 0]], np.r_[n, k[inside[:, 1]]])


class Model:
    """Emissions and transitions; ``states`` are clean and the pairs that can occur."""

    STAY, ENTER, LEAVE = 0.9995, 2e-6, 2e-3

    def __init__(self, lines: Iterable[str] | dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """From lines, or from what ``Tally.states`` has of them."""
        counts = lines if isinstance(lines, dict) else {s: x for s, *x in Tally().add(lines).states()}
        other, usual = counts[0][1][counts[0][0] >> Tally.BITS == 0].sum(axis=0) if 0 in counts else (0, 0)
        weights = 1.0, min(1.0, USUAL_SHARE * max(other, USUAL_LINES) / max(1, usual))
        counts = {s: (two, n @ weights) for s, (two, n) in counts.items()}
        for s, two, n in Tally().add((w for w in SEED.values() for _ in range(5)), sure=True).states():
            if s in counts:
                two, n = np.r_[counts[s][0], two], np.r_[counts[s][1], n.sum(axis=1)]
                counts[s] = _summed(two, n)
            else:
                counts[s] = two, n.sum(axis=1)
        self.pairs: list[tuple[str, str, int] | None] = [PAIRS[s - 1] if s else None for s in sorted(counts)]
        last = (1 << Tally.BITS) - 1
        points = np.unique(np.concatenate([two & last for two, _ in counts.values()]))
        self.alphabet = {chr(c - 1): i + 1 for i, c in enumerate(points)}
        n = len(self.alphabet) + 1
        self.n = n
        self.mark = uuid.uuid4().hex
        self.sparse = []
        for s in sorted(counts):
            two, k = counts[s]
            a, b = two >> Tally.BITS, np.searchsorted(points, two & last) + 1
            u = np.full(n, 1e-7)
            u += np.bincount(b, k, n) / k.sum()
            u[0] = 1e-6
            follows = a > 0  # the others begin a line
            a, b, k = np.searchsorted(points, a[follows]) + 1, b[follows], k[follows]
            self.sparse.append((u.astype(np.float32), a * n + b, (k / (np.bincount(a, k, n)[a] + 2)).astype(np.float32)))


class Table:
    """log P(character | the one before, state); built once per worker.  Neighbours that a pair's state emits have a row with all
    states (at most 256 by 256 of each), those that only clean text has a value, all others what the character alone has."""

    def __init__(self, model: Model) -> None:
        self.n = n = model.n
        base = np.stack([u * np.float32(0.02) for u, _, _ in model.sparse], axis=1)
        self.keys = np.unique(np.concatenate([np.zeros(0, np.int64), *(keys for _, keys, _ in model.sparse[1:])]))
        rows = base[self.keys % n]
        for s, (_, keys, probs) in enumerate(model.sparse[1:], 1):
            rows[np.searchsorted(self.keys, keys), s] += probs * np.float32(0.98)
        self.rows = np.log(np.concatenate([base, rows]))
        _, self.clean_keys, probs = model.sparse[0]
        self.clean_values = np.log(np.r_[base[:, 0], base[self.clean_keys % n, 0] + probs * np.float32(0.98)])
        self.direct = self._direct(self.keys), self._direct(self.clean_keys)

    def _direct(self, keys: np.ndarray) -> np.ndarray | None:
        if self.n * self.n > DIRECT:
            return None
        out = np.tile(np.arange(self.n, dtype=np.int32), self.n)
        out[keys] = np.arange(self.n, self.n + len(keys))
        return out

    def _at(self, index: np.ndarray, keys: np.ndarray, direct: np.ndarray | None) -> np.ndarray:
        if direct is not None:
            return direct[index]
        if not len(keys):
            return index % self.n
        at = np.minimum(np.searchsorted(keys, index), len(keys) - 1)
        return np.where(keys[at] == index, self.n + at, index % self.n)

    def row(self, index: np.ndarray) -> np.ndarray:
        """The row of each pair of characters, for all states but the clean one."""
        return self._at(index, self.keys, self.direct[0])

    def clean(self, index: np.ndarray) -> np.ndarray:
        return self.clean_values[self._at(index, self.clean_keys, self.direct[1])]


_CACHE: dict[str, object] = {}


def _labels(model: Model, segments: list[str]) -> list[np.ndarray]:
    """Viterbi: the state of each character of each segment, for many segments at a time."""
    if _CACHE.get("of") != model.mark:  # a worker may serve several models
        _CACHE.update(of=model.mark, t=Table(model))
    table = _CACHE["t"]
    k = table.rows.shape[1]
    order = sorted(range(len(segments)), key=lambda i: len(segments[i]))
    out: list[np.ndarray] = [np.zeros(0, np.uint8)] * len(segments)
    stay, enter, leave = np.float32(np.log(model.STAY)), np.float32(np.log(model.ENTER)), np.float32(np.log(model.LEAVE))
    at = 0
    while at < len(order):
        rows = ROWS
        while rows > 1 and rows * len(segments[order[min(at + rows, len(order)) - 1]]) > CELLS:
            rows //= 2
        batch = order[at : at + rows]
        at += rows
        most = len(segments[batch[-1]])
        codes = np.zeros((len(batch), most + 1), dtype=np.int64)
        ends = np.array([len(segments[i]) for i in batch])
        get = model.alphabet.get
        space = get(" ", 0)
        for j, i in enumerate(batch):
            codes[j, 0] = space
            codes[j, 1 : ends[j] + 1] = [get(c, 0) for c in segments[i]]
        index = codes[:, :-1] * model.n + codes[:, 1:]
        clean, index = np.ascontiguousarray(table.clean(index).T), np.ascontiguousarray(table.row(index).T)
        score = np.full((len(batch), k), enter, dtype=np.float32)
        score[:, 0] = 0
        came = np.zeros((most, len(batch), k), dtype=bool)  # into a pair's state: from clean; into clean: from a pair's state
        best = np.zeros((most, len(batch)), dtype=np.uint8)  # which one, where it did
        state = np.zeros(len(batch), dtype=np.int64)
        emitted, keep = np.empty_like(score), np.empty_like(score)
        live = 0  # the lines are in order of length
        for t in range(most):
            while ends[live] == t:
                live += 1
            own, kept = score[live:], keep[live:]
            if t:
                back = own[:, 1:].max(axis=1) + leave
                into = own[:, :1] + enter
                np.add(own, stay, out=kept)
                np.greater(into, kept[:, 1:], out=came[t, live:, 1:])
                moved = np.flatnonzero(back > kept[:, 0])
                if len(moved):
                    came[t, live + moved, 0] = True
                    best[t, live + moved] = own[moved, 1:].argmax(axis=1) + 1
                    kept[moved, 0] = back[moved]
                np.maximum(kept[:, 1:], into, out=own[:, 1:])
                own[:, 0] = kept[:, 0]
            more = emitted[live:]
            np.take(table.rows, index[t, live:], axis=0, out=more, mode="clip")
            more[:, 0] = clean[t, live:]
            own += more
        state = score.argmax(axis=1)
        labels = np.zeros((len(batch), most), dtype=np.uint8)
        rows = np.flatnonzero((state > 0) | came[:, :, 0].any(axis=0))  # the others are clean all along
        state, ended = state[rows], ends[rows]
        for t in range(most - 1, -1, -1) if len(rows) else ():
            live = ended > t
            labels[rows, t] = np.where(live, state, 0)
            if t:
                moved = came[t, rows, state] & live
                state = np.where(moved, np.where(state > 0, 0, best[t, rows]), state)
        for j, i in enumerate(batch):
            out[i] = labels[j, : ends[j]]
    return out


def _likelier(model: Model, old: str, new: str) -> bool:
    """Whether the clean state finds the restored text clearly more likely; letter for letter, by 0.3 a character."""
    table = _CACHE["t"]

    def score(x: str) -> float:
        c = np.array([model.alphabet.get(ch, 0) for ch in " " + x])
        return float(table.clean(c[:-1] * model.n + c[1:]).sum())

    return score(new) > score(old) + max(3.0, 0.3 * (len(old) if len(old) == len(new) else 0))


def _case_breaks(text: str) -> int:
    """How often a capital follows a small letter."""
    return sum(a.islower() and b.isupper() for a, b in zip(text, text[1:]))  # noqa: B905


def _spans(model: Model, segment: str, labels: np.ndarray) -> list[tuple[int, int, str, int]]:
    """(start, end, restored, failed) of each labelled span that its inverse transform bears out."""
    out = []
    change = np.nonzero(np.diff(labels))[0] + 1
    for a, b in zip([0, *change], [*change, len(labels)], strict=True):
        pair = model.pairs[int(labels[a])]
        if pair is None:
            continue
        old = segment[a:b]
        new, failed = restore(old, *pair)
        if new == old:
            continue
        odd = sum(map("\x7f".__lt__, old))
        if not odd:
            continue
        if failed:  # the path may enter or leave within the bytes of a character
            x, y = a, b
            while x > (out[-1][1] if out else 0) and labels[x - 1] == 0 and segment[x - 1] > "\x7f":
                x -= 1
            while y < len(segment) and labels[y] == 0 and segment[y] > "\x7f":
                y += 1
            again, lost = restore(segment[x:y], *pair)
            if lost < failed:
                a, b, old, new, failed = x, y, segment[x:y], again, lost
                odd = sum(c > "\x7f" for c in old)
        if pair[0] != "utf-8" and odd < FEW_ODD and _case_breaks(new) > _case_breaks(old):
            continue
        if failed:  # a state beside it may fit better
            for other in model.pairs[1:]:
                again, lost = restore(old, *other)
                if lost < failed and again != old and _likelier(model, new.replace(chr(0xFFFD), ""), again):
                    new, failed = again, lost
        if failed * 2 <= odd and _likelier(model, old, new):
            out.append((int(a), int(b), new, failed))
    return out


def train(df: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> Model:
    """The model from all lines of all rows, without those that the strict test or, in as many rounds, the model so far finds
    garbled, nor those with the signs of such a line of the same row.  They are counted where they are; what leaves the executors is a row for each state and two neighbouring
    characters, so it follows the characters in use (256 by 256 for a pair's state) and not the documents."""
    rows = df.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"))
    every = _counted(rows, None)
    model = Model(_states(every))
    for _ in range(rounds):
        model = Model(_states(every, _counted(rows, model)))
    return model


def _counted(rows: DataFrame, model: Model | None) -> pd.DataFrame:
    """(state, two, other, usual) over all lines, or over those that the model finds garbled."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tally, m = Tally(), shared.value
        for pdf in batches:
            if m is None:
                tally.add(pdf["text"])
                continue
            lines = [(i, x) for i, t in enumerate(pdf["text"]) if not _plain(t) for x in BREAK.split(t) if x and not _plain(x)]
            lines = [x for x, taken in zip(lines, tally.taken([x for _, x in lines]), strict=True) if taken]  # no others were counted
            found = [_spans(m, x, own) if own.any() else [] for (_, x), own in zip(lines, _labels(m, [x for _, x in lines]), strict=True)]
            signs: dict[int, set[str]] = {}
            for (i, x), spans in zip(lines, found, strict=True):
                if spans:
                    signs.setdefault(i, set()).update(c for a, b, *_ in spans for c in x[a:b] if not ORDINARY.fullmatch(c))
            tally.add(x for (i, x), spans in zip(lines, found, strict=True) if spans or i in signs and not signs[i].isdisjoint(x))
        for s, two, n in tally.states():
            yield pd.DataFrame({"state": np.full(len(two), s, dtype=np.int32), "two": two, "other": n[:, 0], "usual": n[:, 1]})

    counts = rows.mapInPandas(run, "state int, two long, other long, usual long")
    return counts.groupBy("state", "two").agg(F.sum("other").alias("other"), F.sum("usual").alias("usual")).toArrow().to_pandas()


def _states(every: pd.DataFrame, less: pd.DataFrame | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """What ``Tally.states`` has, of all lines but those of ``less``."""
    if less is not None:
        every = pd.concat([every, less.assign(other=-less["other"], usual=-less["usual"])])
    out = {}
    for s, own in every.groupby("state"):
        two, n = _summed(own["two"].to_numpy(), own[["other", "usual"]].to_numpy())
        left = n.any(axis=1)
        if left.any():
            out[int(s)] = two[left], n[left]
    return out


def garbled(df: DataFrame, key: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """(key, restored, spans, lost) of each document with garbled passages: the text with what could be restored, the number
    of passages, and how many replacement signs or bytes stay lost."""
    model = model or train(df, key, text)
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the characters in use

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            segments: list[str] = []
            docs: list[tuple[object, list[tuple[str, int]], str]] = []
            for k, t in zip(pdf[key], pdf[text], strict=True):
                if not isinstance(t, str) or not t or _plain(t):
                    continue
                parts: list[tuple[str, int]] = []
                some = False
                for piece in BREAK.split(t):
                    if not piece or _plain(piece):
                        parts.append((piece, -1))
                        continue
                    parts.append((piece, len(segments)))
                    segments.append(piece)
                    some = True
                if some:
                    docs.append((k, parts, t))
            labels = _labels(m, segments) if segments else []
            ids, restored, spans, lost = [], [], [], []
            for k, parts, _ in docs:
                out, n, gone = [], 0, 0
                for s, i in parts:
                    if i < 0:
                        out.append(s)
                        continue
                    last = 0
                    taken = np.zeros(len(s), dtype=bool)
                    if labels[i].any():
                        for a, b, new, failed in _spans(m, s, labels[i]):
                            out += [s[last:a], new]
                            last = b
                            taken[a:b] = True
                            n += 1
                            gone += failed
                    out.append(s[last:])
                    for x in BAD.finditer(s):
                        if not taken[x.start()]:
                            n += 1
                            gone += 1
                if n:
                    ids.append(k)
                    restored.append("".join(out))
                    spans.append(n)
                    lost.append(gone)
            yield pd.DataFrame({key: pd.Series(ids, dtype=pdf[key].dtype), "restored": pd.Series(restored, dtype=object), "spans": pd.Series(spans, dtype="int32"), "lost": pd.Series(lost, dtype="int32")})

    kind = df.schema[key].dataType.simpleString()
    return df.filter(F.col(key).isNotNull()).select(key, text).mapInPandas(run, f"{key} {kind}, restored string, spans int, lost int")
