"""Problem 1: near-duplicate records, by a multi-index Hamming join.

A record's signature has one bit for each hash value of a word and holds the words of title and snippet (in consistent
form) as set bits, so two records whose word sets differ in d words lie at Hamming distance at most d.  For a Jaccard
similarity of at least t, d is at most (a + b)(1 - t)/(1 + t) for sets of a and b words.  The signature is split into
g groups of s chunks.  By the pigeonhole principle, a pair within distance 2g - 1 has a group with at most one error;
leaving out each chunk of a group in turn enumerates where it may be.  So both records share at least one of
g * s keys: *every* pair under the threshold meets, whatever its bits are.  Sets of different sizes allow different
distances, so sizes are served by a ladder of schemes with growing g; a record takes part in the (one or two) schemes
that its possible partners need.

Records with the same words are collapsed first.  Rows with one key are compared in sorted streams, vectorised, by a
64-bit fold of the signature.  A key that more than ``MAX_BUCKET`` rows share isn't compared: its rows are keyed once more
with a second group (within distance 2g - 1, the other g - 1 groups leave one with at most (2g - 1) // (g - 1) errors),
and what is still too common after that is split into blocks, each pair of blocks being one task.  No pair is lost,
none is compared in an unbounded group.  Survivors are verified exactly on their word sets.

Edge cases: rows without an id are left out; null and empty fields have no words; records under ``min_words`` different words are never paired; a row that
is repeated as a whole is one record; ties do not arise (pairs are ordered by id).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from raqim.llm.lookalike import SUSPECT, form_table, language, normalizer, plain_words
from raqim.session import checkpointed

MIN_WORDS, THRESHOLD = 24, 0.75
CHUNKS = 3
#: Comparing a row with n others costs about 5 n ns, keying it once more with a second group as much as some 29,000 comparisons.
MAX_BUCKET = 16_384
FIRST_GROUPS, GROWTH = 7, 1.4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def distance_bound(total: int | np.ndarray, threshold: float = THRESHOLD) -> int | np.ndarray:
    """The most words in which two sets with ``total`` words together may differ: total (1 - t)/(1 + t), rounded down."""
    return np.floor(np.asarray(total) * (1 - threshold) / (1 + threshold) + 1e-9).astype(np.int64)


def ladder(largest: int, threshold: float = THRESHOLD) -> list[tuple[int, int, int]]:
    """Schemes (groups, lo, hi): pairs with lo < a + b <= hi words differ in at most 2 * groups - 1 words."""
    out, lo, g = [], 0, FIRST_GROUPS
    while True:
        hi = int(np.ceil(2 * g * (1 + threshold) / (1 - threshold) - 1e-9)) - 1
        out.append((g, lo, hi))
        if hi >= 2 * largest:
            return out
        lo, g = hi, int(np.ceil(g * GROWTH))


def word_sets(df: DataFrame, key: str = "id", fields: tuple[str, ...] = ("title", "snippet"), min_words: int = MIN_WORDS) -> DataFrame:
    """(id, content: hash of the word set, words: sorted 32-bit hashes of the different words) of records with enough words.
    Two words of one pair share a hash once in about a million pairs; such a pair is judged with one word less."""
    present = [f for f in fields if f in df.columns]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        norm = normalizer(form_table())
        known: dict[str, int] = {}
        for pdf in batches:
            ids, contents, sets = [], [], []
            for k, *values in pdf.itertuples(index=False, name=None):
                text = "\n".join(v for v in values if isinstance(v, str))
                if SUSPECT.search(text):
                    text = norm.scan(text, language(text))[1]
                hashes = set()
                for w in plain_words(text.lower()):
                    h = known.get(w)
                    if h is None:
                        if len(known) > 500_000:
                            known.clear()
                        known[w] = h = xxhash.xxh32_intdigest(w) - (1 << 31)
                    hashes.add(h)
                if len(hashes) >= min_words:
                    a = np.sort(np.fromiter(hashes, dtype=np.int32, count=len(hashes)))
                    ids.append(k)
                    contents.append(xxhash.xxh3_64_intdigest(a.tobytes()) - (1 << 63))
                    sets.append(a)
            yield pd.DataFrame({"id": pd.Series(ids, dtype="int64"), "content": pd.Series(contents, dtype="int64"), "words": pd.Series(sets, dtype=object)})

    return df.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), *present).mapInPandas(run, "id long, content long, words array<int>")


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each value."""
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) + np.uint64(seed)) * _MIX
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _flat(words: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, row of each word, hash of each word)."""
    sizes = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
    flat = np.concatenate([np.asarray(w, dtype=np.int32) for w in words]) if len(words) else np.zeros(0, np.int32)
    return sizes, np.repeat(np.arange(len(words)), sizes), _mixed(flat.astype(np.int64).view(np.uint64), 1)


def _chunk_values(words: pd.Series, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, value of each chunk by row): a chunk's value is the sum of hashes of its set bits."""
    sizes, rows, h = _flat(words)
    m = groups * CHUNKS
    values = np.zeros((len(words), m), dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(values, (rows, (h >> np.uint64(40)) % np.uint64(m)), _mixed(h, 2))
    return sizes, values


def _fold(words: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, signature folded to 64 bits: each word flips one bit)."""
    sizes, rows, h = _flat(words)
    out = np.zeros(len(words), dtype=np.uint64)
    np.bitwise_xor.at(out, rows, np.uint64(1) << (h >> np.uint64(58)))
    return sizes, out


def _keys(values: np.ndarray, group: int, errors: int) -> Iterator[np.ndarray]:
    """Keys of one group of chunks: what is left when ``errors`` of its chunks are left out, in every way."""
    base = group * CHUNKS
    for keep in combinations(range(CHUNKS), CHUNKS - errors):
        with np.errstate(over="ignore"):
            k = np.full(len(values), 1469598103934665603 + 7919 * group + sum(31**i * (c + 1) for i, c in enumerate(keep)), dtype=np.uint64)
            for c in keep:
                k = _mixed(k ^ values[:, base + c], 3)
        yield k


KEYS = "key long, id long, fold long, size int, scheme byte, grp int"


def _first_keys(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            sizes, fold = _fold(pdf["words"])
            ids = pdf["id"].to_numpy()
            least, most = sizes + np.ceil(sizes * threshold - 1e-9), sizes + np.floor(sizes / threshold + 1e-9)
            for scheme, (g, lo, hi) in enumerate(ladder(int(most.max()), threshold)):  # partners may be in other batches and larger
                part = (least <= hi) & (most > lo)
                if not part.any():
                    continue
                values = _chunk_values(pdf["words"][part], g)[1]
                for group in range(g):
                    for k in _keys(values, group, 1):
                        yield pd.DataFrame({"key": k.view(np.int64), "id": ids[part], "fold": fold[part].view(np.int64), "size": sizes[part].astype(np.int32), "scheme": np.int8(scheme), "grp": np.int32(group)})

    return run


def _second_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hot rows keyed with a second group each: what a pair within the scheme's distance must share besides the first."""
    for pdf in batches:
        for (scheme, grp), part in pdf.groupby(["scheme", "grp"]):
            g = ladder(1 << 20)[int(scheme)][0]
            errors = min(CHUNKS - 1, (2 * g - 1) // (g - 1))
            values = _chunk_values(part["words"], g)[1]
            first = part["key"].to_numpy().view(np.uint64)
            for group in range(g):
                if group != grp:
                    for k in _keys(values, group, errors):
                        yield pd.DataFrame({"key": _mixed(first ^ (k << np.uint64(1)), 5).view(np.int64), "id": part["id"], "fold": part["fold"], "size": part["size"], "scheme": part["scheme"], "grp": part["grp"]})


FOUND = "a long, b long, key long, id long, fold long, size int, scheme byte, grp int"


def _compare(ids: np.ndarray, fold: np.ndarray, size: np.ndarray, threshold: float, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bucket whose folded signatures lie within the distance bound of their sizes; of two ``blocks``, only those between them."""
    if blocks is not None and (blocks == blocks[0]).all():
        blocks = None
    left, right = [], []
    for i in range(len(ids) - 1):
        total = size[i + 1 :] + size[i]
        near = np.bitwise_count(fold[i + 1 :] ^ fold[i]) <= distance_bound(total, threshold)
        if blocks is not None:
            near &= blocks[i + 1 :] != blocks[i]
        j = np.nonzero(near)[0]
        if len(j):
            left.append(np.full(len(j), ids[i]))
            right.append(ids[i + 1 + j])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(right)
    keep = a != b
    return np.minimum(a, b)[keep], np.maximum(a, b)[keep]


def _small(starts: np.ndarray, ends: np.ndarray, ids: np.ndarray, fold: np.ndarray, size: np.ndarray, threshold: float) -> tuple[list, list]:
    """All small buckets of a batch at once, by their offset d: row i with row i + d of the same bucket."""
    left, right = [], []
    bucket = np.repeat(np.arange(len(starts)), ends - starts)
    row = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends, strict=True)]) if len(starts) else np.zeros(0, np.int64)
    f, z, k = fold[row], size[row].astype(np.int64), ids[row]
    d = 1
    while True:
        same = np.nonzero(bucket[d:] == bucket[:-d])[0] if d < len(bucket) else np.zeros(0, np.int64)
        if not len(same):
            return left, right
        near = np.bitwise_count(f[same] ^ f[same + d]) <= distance_bound(z[same] + z[same + d], threshold)
        hit = same[near]
        if len(hit):
            a, b = k[hit], k[hit + d]
            keep = a != b
            left.append(np.minimum(a, b)[keep])
            right.append(np.maximum(a, b)[keep])
        d += 1


def _pairs_frame(a: np.ndarray, b: np.ndarray, hot: pd.DataFrame | None = None) -> pd.DataFrame:
    out = pd.DataFrame({"a": pd.Series(a, dtype="Int64"), "b": pd.Series(b, dtype="Int64")})
    for c, kind in (("key", "Int64"), ("id", "Int64"), ("fold", "Int64"), ("size", "Int32"), ("scheme", "Int8"), ("grp", "Int32")):
        out[c] = pd.Series([None] * len(out), dtype=kind)
    if hot is None or not len(hot):
        return out
    rows = hot[["key", "id", "fold", "size", "scheme", "grp"]].assign(a=pd.Series([None] * len(hot), dtype="Int64", index=hot.index), b=pd.Series([None] * len(hot), dtype="Int64", index=hot.index))
    return pd.concat([out, rows[out.columns]], ignore_index=True).astype(out.dtypes)


def _buckets(threshold: float, most: int, blocked: bool = False):
    """Compare a stream sorted by key: buckets of up to ``most`` rows give pairs, rows of larger ones come out as hot.
    ``blocked``: ``grp`` is the row's block, and a bucket is a block or a pair of blocks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None
        hot_key: int | None = None
        for pdf in batches:
            if rest is not None and len(rest):
                pdf = pd.concat([rest, pdf], ignore_index=True)
            rest, hot_key, out = _batch(pdf, hot_key, False)
            yield out
        if rest is not None and len(rest):
            yield _batch(rest, hot_key, True)[2]

    def _batch(pdf: pd.DataFrame, hot_key: int | None, final: bool) -> tuple[pd.DataFrame | None, int | None, pd.DataFrame]:
        key = pdf["key"].to_numpy()
        if not len(key):
            return None, hot_key, _pairs_frame(key, key)
        starts = np.concatenate([[0], np.nonzero(key[1:] != key[:-1])[0] + 1])
        ends = np.append(starts[1:], len(key))
        sizes = ends - starts
        large = (sizes > most) | (key[starts] == (hot_key if hot_key is not None else ~key[starts]))
        if hot_key is None:
            large = sizes > most
        last_open = not final and not large[-1]
        hot_key = int(key[-1]) if large[-1] else None
        done = len(starts) - int(last_open)
        ids, fold, size = pdf["id"].to_numpy(), pdf["fold"].to_numpy().view(np.uint64), pdf["size"].to_numpy().astype(np.int64)
        pick = ~large[:done] & (sizes[:done] > 1)
        little = pick & (sizes[:done] <= 64) & (not blocked)
        block = pdf["grp"].to_numpy() if blocked else None
        left, right = _small(starts[:done][little], ends[:done][little], ids, fold, size, threshold)
        for i in np.nonzero(pick & ~little)[0]:
            s, e = starts[i], ends[i]
            a, b = _compare(ids[s:e], fold[s:e], size[s:e], threshold, None if block is None else block[s:e])
            left.append(a)
            right.append(b)
        a = np.concatenate(left) if left else np.zeros(0, np.int64)
        b = np.concatenate(right) if right else np.zeros(0, np.int64)
        if len(a):
            both = np.unique(np.stack([a, b], axis=1), axis=0)
            a, b = both[:, 0], both[:, 1]
        hot_rows = np.zeros(len(key), dtype=bool)
        for i in np.nonzero(large[:done])[0]:
            hot_rows[starts[i] : ends[i]] = True
        out = _pairs_frame(a, b, pdf[hot_rows] if hot_rows.any() else None)
        return (pdf.iloc[starts[-1] :].reset_index(drop=True) if last_open else None), hot_key, out

    return run


def _block_pairs(hot: DataFrame, threshold: float, most: int) -> DataFrame:
    """What two groups of chunks leave too common: each bucket in blocks, each block and each pair of blocks a task of its own."""
    n = hot.groupBy("key").agg(F.ceil(F.count("*") / (most // 2)).cast("int").alias("n"))
    rows = hot.join(n, "key").withColumn("grp", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    each = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    each = each.withColumn("key", F.xxhash64("key", F.least("grp", "other"), F.greatest("grp", "other")))
    return _joined(each.select("key", "id", "fold", "size", "scheme", "grp"), threshold, 1 << 30, blocked=True)


def _joined(keys: DataFrame, threshold: float, most: int, blocked: bool = False) -> DataFrame:
    return keys.repartition("key").sortWithinPartitions("key").mapInPandas(_buckets(threshold, most, blocked), FOUND)


def candidates(sets: DataFrame, threshold: float = THRESHOLD, most: int = MAX_BUCKET) -> DataFrame:
    """(a, b), a < b: all pairs of ``sets`` within the distance bound, and few others."""
    keys = sets.select("id", "words").mapInPandas(_first_keys(threshold), KEYS)
    first = checkpointed(_joined(keys, threshold, most))
    hot = first.filter("a is null").select("key", "id", "fold", "size", "scheme", "grp")
    again = hot.join(sets.select("id", "words"), "id").mapInPandas(_second_keys, KEYS)
    second = checkpointed(_joined(again, threshold, most))
    third = _block_pairs(second.filter("a is null").select("key", "id", "fold", "size", "scheme", "grp"), threshold, most)
    found = first.filter("a is not null").select("a", "b").union(second.filter("a is not null").select("a", "b")).union(third.filter("a is not null").select("a", "b"))
    return found.distinct()


def similar_pairs(sets: DataFrame, threshold: float = THRESHOLD, most: int = MAX_BUCKET) -> DataFrame:
    """(a, b, similarity) of the pairs of different word sets that reach the threshold; ids are of ``sets``.  Where ``sets`` has a
    column n, the number of copies, its values come out as na and nb."""
    own = [c for c in sets.columns if c == "n"]
    words = sets.select("id", "words", *own)
    left, right = (words.withColumnsRenamed({"id": x, "words": f"w{x}", "n": f"n{x}"}) for x in "ab")
    both = candidates(sets, threshold, most).join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("wa", "wb"))
    similar = both.select("a", "b", (shared / (F.size("wa") + F.size("wb") - shared)).alias("similarity"), *(f"n{x}" for x in "ab" if own))
    return similar.filter(F.col("similarity") >= threshold - 1e-12)


def near_duplicates(df: DataFrame, key: str = "id", threshold: float = THRESHOLD, min_words: int = MIN_WORDS, most: int = MAX_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(members: id, class id of equal word sets, n members of it; links: a, b, similarity between classes, na, nb).  A class is
    named by its least id."""
    all_sets = checkpointed(word_sets(df, key, min_words=min_words).dropDuplicates(["id"]))
    classes = all_sets.groupBy("content").agg(F.min("id").alias("class"), F.count("*").alias("n"))
    members = all_sets.select("id", "content").join(classes, "content").select("id", "class", "n")
    sets = all_sets.join(classes.select(F.col("class").alias("id"), "n"), "id")
    return members, similar_pairs(sets, threshold, most)


#: Copies of a class that one task pairs with others; larger classes are cut into blocks of about so many.
COPIES = 4096


def duplicate_pairs(df: DataFrame, copies: int = COPIES, **options) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of records that reach the threshold, copies included.  Members of a class are spread
    over blocks, and a link or a class is expanded block by block, so no key holds more than a block's rows on either side."""
    members, links = near_duplicates(df, **options)
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / copies)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    members = checkpointed(members.withColumn("block", F.pmod(F.xxhash64("id"), blocks("n")).cast("int")))
    copied = members.filter("n > 1")
    left = copied.select("class", F.col("id").alias("id_a"), F.col("block").alias("ba"), each("n").alias("bb"))
    right = copied.select("class", F.col("id").alias("id_b"), F.col("block").alias("bb"), each("n").alias("ba"))
    same = left.join(right, ["class", "ba", "bb"]).filter("id_a < id_b").select("id_a", "id_b")
    spread = links.select("a", "b", "nb", each("na").alias("ba"))
    x = spread.join(members.select(F.col("class").alias("a"), F.col("block").alias("ba"), F.col("id").alias("x")), ["a", "ba"])
    x = x.select("x", "b", each("nb").alias("bb")).join(members.select(F.col("class").alias("b"), F.col("block").alias("bb"), F.col("id").alias("y")), ["b", "bb"])
    return x.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).union(same)


def groups(df: DataFrame, **options) -> DataFrame:
    """One row per record with enough words: (id, group: least id that links lead to, links: number of near-duplicates)."""
    members, links = near_duplicates(df, **options)
    members, links = checkpointed(members), checkpointed(links)
    edges = links.select("a", "b", F.col("nb").alias("n")).union(links.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("na").alias("n")))
    label = edges.select(F.col("a").alias("v")).distinct().withColumn("label", F.col("v"))
    moved = True
    while moved:  # the least label spreads along edges, and jumps to the label of the label, until none moves
        spread = edges.join(label.withColumnRenamed("v", "b"), "b").groupBy(F.col("a").alias("v")).agg(F.min("label").alias("near"))
        step = label.join(spread, "v").select("v", F.least("label", "near").alias("new"), "label")
        jump = step.select(F.col("v").alias("new"), F.col("new").alias("far"))
        least = F.least("new", F.coalesce("far", "new"))
        after = checkpointed(step.join(jump, "new", "left").select("v", least.alias("label"), (least < F.col("label")).alias("moved")))
        label, moved = after.select("v", "label"), not after.filter("moved").isEmpty()
    linked = edges.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("others"))
    per_class = linked.join(label.withColumnRenamed("v", "class"), "class")
    return members.join(per_class, "class", "left").select("id", F.coalesce("label", "class").alias("group"), (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("links"))
