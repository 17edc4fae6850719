"""Problem 6: lines and blocks of lines that recur through the records of one site.

The values of a site are turned into sequences of line identifiers, and the site's *suffix array* is built over them.  It
is built by buckets, as radix suffix sorting does: the first pass buckets all suffixes by (site, first line) and counts the
distinct records of each bucket, which are the level-1 LCP intervals; only suffixes that go on with another repeated line
are sorted further.  Equal suffixes are merged, with their number of records, before they are sorted, so a line that
a third of all rows share costs one row per *different* continuation.  Adjacent suffixes are compared, and every interval
of common prefixes gives a block with the number of records that hold it.

What is taken out is decided by these intervals: a line recurs if it lies in a block of at least ``min_lines`` lines that
``min_records`` records share.  Every window of such a block recurs as well, so the intervals that reach the depth of
``min_lines`` are joined to the positions whose next lines are theirs, and all their lines go.

A record that holds a block twice counts once: within each record the suffixes are sorted, and each pair of neighbours
takes the prefix they share off the count again (the colour-set-size correction).

A run of more than ``DEPTH`` recurring lines is sorted by windows of that many, which are also the longest blocks reported; what
is taken out is the same.

Edge cases: null and empty values have no lines; blank lines are no lines to remove; a record repeated as a whole row
(same id and value) counts once; a null URL belongs to no site, its values are returned unchanged; so are those of
rows without a key.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raqim.llm.hosts import site
from raqim.llm.lookalike import Forms, character_counts, form_table, language, normalizer
from raqim.session import checkpointed

BREAK = re.compile(r"\r\n|\n|\r")
DIGITS = re.compile(r"\d+")
MIN_RECORDS = 5
#: The most lines by which suffixes are ordered.
DEPTH = 64


def line_key(form: str) -> str:
    """What two equal lines share: the consistent form, outer and repeated spaces set aside, any run of digits equal to any other."""
    return DIGITS.sub("0", " ".join(form.lower().split()))


def lines(df: DataFrame, key: str = "id", fields: tuple[str, ...] = ("snippet", "description"), url: str = "url", rules: Forms | None = None) -> DataFrame:
    """One row per line that isn't blank: (key, field, line_no from 1, line: 64-bit identifier of site and line key)."""
    fields = tuple(f for f in fields if f in df.columns)
    if rules is None:
        rules = form_table(character_counts(df, [*fields]))
    source = df.filter(F.col(url).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("id"), *fields, site(F.col(url)).alias("site__"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        norm = normalizer(rules)
        for pdf in batches:
            ids, fs, nos, hs = [], [], [], []
            columns = [pdf[f].tolist() for f in fields]
            for i, (k, s) in enumerate(zip(pdf["id"].tolist(), pdf["site__"].tolist(), strict=True)):
                lang = None
                for f, values in zip(fields, columns, strict=True):
                    v = values[i]
                    if not isinstance(v, str):
                        continue
                    for no, line in enumerate(BREAK.split(v), 1):
                        if norm.gate.search(line):
                            if lang is None:
                                lang = language("\n".join(c[i] for c in columns if isinstance(c[i], str)))
                            line = norm.scan(line, lang)[1]
                        t = line_key(line)
                        if t:
                            ids.append(k)
                            fs.append(f)
                            nos.append(no)
                            hs.append(xxhash.xxh64_intdigest(f"{s}\n{t}") - (1 << 63))
            yield pd.DataFrame({"id": ids, "field": pd.Series(fs, dtype=object), "line_no": nos, "line": pd.Series(hs, dtype="int64")})

    return source.mapInPandas(run, "id long, field string, line_no int, line long")


def repeated(found: DataFrame, min_records: int = MIN_RECORDS) -> DataFrame:
    """Level-1 intervals of the suffix arrays: (line, records) with at least ``min_records`` distinct records."""
    return found.groupBy("line").agg(F.countDistinct("id").alias("records")).filter(F.col("records") >= min_records)


def repeated_lines(df: DataFrame, min_records: int = MIN_RECORDS, min_lines: int = 1, **options) -> DataFrame:
    """(id, field, line_no, records) of each line of a block of at least ``min_lines`` consecutive lines (a single line is a block
    of one) that at least ``min_records`` records of its site hold, in any of the fields; ``records`` of the most frequent such block."""
    found = checkpointed(lines(df, **options))
    blocks_ = _blocks(found, min_records, min_lines)
    start = blocks_.select(F.slice("block", 1, min_lines).alias("window"), "records").groupBy("window").agg(F.max("records").alias("records"))
    if min_lines == 1:
        return found.join(start.select(F.col("window")[0].alias("line"), "records"), "line").select("id", "field", "line_no", "records")
    follow = Window.partitionBy("id", "field").orderBy("line_no").rowsBetween(Window.currentRow, min_lines - 1)
    seen = found.distinct().withColumn("window", F.collect_list("line").over(follow)).withColumn("last", F.max("line_no").over(follow))
    whole = seen.filter((F.size("window") == min_lines) & (F.col("last") - F.col("line_no") == min_lines - 1))
    covered = whole.join(start, "window").select("id", "field", F.explode(F.sequence("line_no", "last")).alias("line_no"), "records")
    return covered.groupBy("id", "field", "line_no").agg(F.max("records").alias("records"))


def _suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per record: suffixes of repeated lines with weight 1, and the correction for what they share."""
    for pdf in batches:
        out, weights = [], []
        for runs in pdf["runs"]:
            own = []
            for run in {tuple(r) for r in runs}:
                own += [run[i : i + DEPTH] for i in range(len(run))]
            own.sort()
            for i, s in enumerate(own):
                out.append(list(s))
                weights.append(1)
                if i:
                    n = _common(own[i - 1], s)
                    if n:
                        out.append(list(s[:n]))
                        weights.append(-1)
        yield pd.DataFrame({"suffix": pd.Series(out, dtype=object), "weight": pd.Series(weights, dtype="int64")})


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):  # noqa: B905
        if x != y:
            break
        n += 1
    return n


def _intervals(min_records: int, min_lines: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Blocks of a sorted stream of suffixes: a stack of open prefixes, closed as soon as the next suffix leaves them."""
        last: tuple = ()
        open_: list[int] = []  # records so far of the prefixes of ``last``, by length
        for pdf in batches:
            out: list[tuple[list[int], int]] = []
            for suffix, weight in zip(pdf["suffix"], pdf["weight"], strict=True):
                s = tuple(suffix)
                n = _common(last, s)
                _close(last, open_, n, out, min_records, min_lines)
                open_ += [0] * (len(s) - n)
                for i in range(len(s)):
                    open_[i] += weight
                last = s
            yield _block_rows(out)
        out = []
        _close(last, open_, 0, out, min_records, min_lines)
        yield _block_rows(out)

    return run


def _block_rows(out: list[tuple[list[int], int]]) -> pd.DataFrame:
    return pd.DataFrame({"block": pd.Series([b for b, _ in out], dtype=object), "records": pd.Series([r for _, r in out], dtype="int64")})


def _close(last: tuple, open_: list[int], to: int, out: list, min_records: int, min_lines: int) -> None:
    """Close the prefixes longer than ``to``; report each that has more records than the longer one it belongs to."""
    longer = 0
    while len(open_) > to:
        n, records = len(open_), open_.pop()
        if records >= min_records and records > longer and n >= min_lines:
            out.append((list(last[:n]), records))
        longer = max(longer, records if records >= min_records else 0)


def blocks(df: DataFrame, min_records: int = MIN_RECORDS, min_lines: int = 2, **options) -> DataFrame:
    """Repeated blocks of at least ``min_lines`` consecutive lines: (block: line identifiers, lines, records), right-maximal."""
    found = checkpointed(lines(df, **options))
    return _blocks(found, min_records, min_lines)


def _blocks(found: DataFrame, min_records: int, min_lines: int) -> DataFrame:
    kept = found.join(repeated(found, min_records), "line").select("id", "field", "line_no", "line").distinct()
    values = kept.groupBy("id", "field").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("v"))
    # a value's lines are cut into runs of consecutive repeated lines; a value is bounded by its field, not by the corpus
    starts = F.expr("filter(sequence(0, size(v) - 1), i -> i = 0 or v[i].line_no <> v[i - 1].line_no + 1)")
    ends = F.expr("transform(a, (x, i) -> if(i + 1 < size(a), a[i + 1], size(v)) - x)")
    runs = values.withColumn("a", starts).withColumn("n", ends).select("id", F.expr("filter(zip_with(a, n, (x, k) -> slice(v.line, x + 1, k)), r -> size(r) >= %d)" % min_lines).alias("r")).filter(F.size("r") > 0)
    per_record = runs.groupBy("id").agg(F.flatten(F.collect_list("r")).alias("runs")).select("runs")
    suffixes = per_record.mapInPandas(_suffixes, "suffix array<long>, weight long")
    merged = suffixes.groupBy("suffix").agg(F.sum("weight").alias("weight")).filter("weight <> 0")
    # the suffixes of one interval meet in one task; those too short for a block are in none
    ordered = merged.filter(F.size("suffix") >= min_lines).repartition(*(F.col("suffix")[i] for i in range(min(2, min_lines)))).sortWithinPartitions("suffix")
    return ordered.mapInPandas(_intervals(min_records, min_lines), "block array<long>, records long").withColumn("lines", F.size("block"))


def cleaned(df: DataFrame, key: str = "id", fields: tuple[str, ...] = ("snippet", "description"), min_records: int = MIN_RECORDS, min_lines: int = 1, **options) -> DataFrame:
    """Each record's values without its site's repeated blocks: (key, one column per field, removed: number of lines taken out).
    Line breaks between the kept lines stay as they were; a value whose lines all recur becomes the empty string."""
    hits = repeated_lines(df, min_records, min_lines, key=key, fields=fields, **options)
    taken = hits.select("id", "field", "line_no").distinct().groupBy("id").agg(F.collect_list(F.struct("field", "line_no")).alias("taken__"))
    joined = df.select(F.col(key), *fields).join(taken.withColumnRenamed("id", key), key, "left")
    kept = [_without(f).alias(f) for f in fields]
    return joined.select(key, *kept, F.coalesce(F.size("taken__"), F.lit(0)).alias("removed"))


def _without(field: str) -> Column:
    """The value without its taken lines; each line keeps the break that follows it."""
    pieces, breaks = F.split(F.col(field), r"\r\n|\n|\r"), F.regexp_extract_all(F.col(field), F.lit(r"(\r\n|\n|\r)"), F.lit(1))
    numbers = F.transform(F.filter("taken__", lambda t: t["field"] == field), lambda t: t["line_no"])
    ended = F.transform(pieces, lambda p, i: F.when(F.array_contains(numbers, i + 1), "").otherwise(F.concat(p, F.coalesce(F.get(breaks, i), F.lit("")))))
    text = F.regexp_replace(F.array_join(ended, ""), r"[\r\n]+$", "")
    return F.when(F.col("taken__").isNull() | (F.size(numbers) == 0), F.col(field)).otherwise(text)
