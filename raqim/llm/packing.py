"""Problem 7: filling containers of fixed capacity with texts.

Hierarchical multi-length packing.  A capacity C has the context sizes C, C/4, C/16, ... (``contexts``), and each text is routed
to the smallest that holds it.  Tier by tier, from the longest texts to the shortest: texts fill the gaps of the longer
windows, best fit first; those that no gap takes are packed into windows of their tier's own size, and these windows,
placed as wholes, into containers, whose gaps the next tiers fill.  At last the emptiest containers are taken apart again
where that saves some.  Planning works on the histogram of lengths, which has at most C rows whatever the number of texts:
it gives runs of equal containers, and for each length the slots in which its 1st, 2nd, ... text goes.  Texts are then ranked
within their length and look their slot up, so no task sees more than a share of one length.  Containers are numbered by fill and dealt to
step groups in a snake order, which balances the tokens of the groups.

Edge cases: null and empty texts have no tokens and are in no container, nor are rows without a key; a text longer than the capacity, and only such a
one, is split into full containers and a rest; repeated rows are packed as often as they occur (told apart by a number);
ties of length are ranked by id.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raqim.session import checkpointed

GROUP = 64
HOT = 100_000
#: Context sizes: each this part of the longer one, none below this many tokens.
RATIO, LEAST = 4, 64
#: Container sizes are few; a plan is made for each.
CONTAINERS = 1000


def contexts(capacity: int) -> list[int]:
    """The context sizes of a capacity, from the capacity itself down: each a ``RATIO``-th of the one before."""
    out = [capacity]
    while out[-1] // RATIO >= LEAST:
        out.append(out[-1] // RATIO)
    return out


class Shelf:
    """Open boxes of one capacity, as runs of equal ones: gap -> [(how many, content)].  A content is linked: (the content before, item)."""

    def __init__(self, capacity: int, runs: list[tuple[int, int, tuple[int, ...]]] = ()) -> None:
        self.capacity = capacity
        self.items: list[tuple[int, ...]] = []
        self.nodes: list[tuple[int, int]] = []
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.gaps: list[int] = []
        for used, n, lengths in runs:
            self._push(capacity - used, n, self._node(-1, lengths))

    def _node(self, before: int, lengths: tuple[int, ...]) -> int:
        self.items.append(lengths)
        self.nodes.append((before, len(self.items) - 1))
        return len(self.nodes) - 1

    def _push(self, gap: int, n: int, node: int) -> None:
        if not self.open.get(gap):
            insort(self.gaps, gap)
        self.open[gap].append((n, node))

    def fill(self, lengths: tuple[int, ...], n: int) -> int:
        """Put n packs of these lengths into the gaps that fit best; the number that no gap takes."""
        size = sum(lengths)
        while n:
            i = bisect_left(self.gaps, size)
            if i == len(self.gaps):
                break
            gap = self.gaps[i]
            m, node = self.open[gap].pop()
            if not self.open[gap]:
                self.gaps.pop(i)
            used = min(m, n)
            if used < m:
                self._push(gap, m - used, node)
            self._push(gap - size, used, self._node(node, lengths))
            n -= used
        return n

    def put(self, lengths: tuple[int, ...], n: int) -> None:
        """Put n packs of these lengths into gaps, the rest into new boxes, as many to one as fit."""
        n, size = self.fill(lengths, n), sum(lengths)
        fit = self.capacity // size
        for k, m in ((fit, n // fit), (n % fit, 1 if n % fit else 0)):
            if m and k:
                node = -1
                for _ in range(k):
                    node = self._node(node, lengths)
                self._push(self.capacity - k * size, m, node)

    def runs(self) -> list[tuple[int, int, tuple[int, ...]]]:
        """(used, how many, lengths) of equal boxes, the fullest first."""
        found: dict[tuple[int, ...], int] = defaultdict(int)
        for items in self.open.values():
            for n, node in items:
                lengths: list[int] = []
                while node >= 0:
                    node, item = self.nodes[node]
                    lengths += self.items[item]
                found[tuple(sorted(lengths, reverse=True))] += n
        return sorted(((sum(k), n, k) for k, n in found.items()), key=lambda r: (-r[0], r[2]))


class Plan:
    """The containers of one capacity: per length, sorted first ranks of its slot runs with container, slot and start of each."""

    def __init__(self, capacity: int, counts: dict[int, int]) -> None:
        self.capacity = capacity
        sizes = contexts(capacity)
        shelf = Shelf(capacity)
        for size, below in zip(sizes, [*sizes[1:], 0], strict=True):
            tier = Shelf(size)
            for length in sorted((x for x in counts if below < x <= size), reverse=True):
                left = shelf.fill((length,), counts[length])  # gaps of the longer windows come first
                if left:
                    tier.put((length,), left)
            for _, n, lengths in tier.runs():  # the tier's own windows: whole containers, or as many to one as fit
                shelf.put(lengths, n)
        self._number(self._settled(shelf.runs()))

    def _settled(self, runs: list[tuple[int, int, tuple[int, ...]]]) -> list[tuple[int, int, tuple[int, ...]]]:
        """Take the emptiest containers apart, as many as all gaps together could hold, then twice as many and so on while some
        stay, and pack their texts anew where that saves containers."""
        total = sum(n for _, n, _ in runs)
        apart = max(1, sum((self.capacity - used) * n for used, n, _ in runs) // self.capacity)
        while apart < total:
            kept, loose, left = [], defaultdict(int), apart
            for used, n, lengths in reversed(runs):
                out = min(n, left)
                left -= out
                for x in lengths if out else ():
                    loose[x] += out
                if n > out:
                    kept.append((used, n - out, lengths))
            shelf = Shelf(self.capacity, kept)
            for x in sorted(loose, reverse=True):
                shelf.put((x,), loose[x])
            after = shelf.runs()
            if (now := sum(n for _, n, _ in after)) < total:
                total, runs = now, after
            apart *= 2
        return runs

    def _number(self, runs: list[tuple[int, int, tuple[int, ...]]]) -> None:
        """Containers in order of fill; each run of equal ones has a first number."""
        slots: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)  # length -> (containers, first container, slot, start)
        first = 0
        for _, n, lengths in runs:
            start = 0
            for slot, length in enumerate(lengths):
                slots[length].append((n, first, slot, start))
                start += length
            first += n
        self.containers = first
        self.slots = {}
        for length, items in slots.items():
            a = np.array(items, dtype=np.int64)
            self.slots[length] = (np.concatenate([[0], np.cumsum(a[:, 0])[:-1]]), a[:, 1], a[:, 2], a[:, 3])

    def look_up(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(container, slot, start) of the texts of a length with these ranks."""
        firsts, container, slot, start = self.slots[length]
        i = np.searchsorted(firsts, ranks, side="right") - 1
        return container[i] + ranks - firsts[i], slot[i], start[i]


def pieces(sized: DataFrame, capacities: list[tuple[str, int]], key: str = "doc_id") -> DataFrame:
    """One row per container size and piece: (container, capacity, key, copy, piece, from_token, size)."""
    numbered = sized.filter((F.col("tokens") > 0) & F.col(key).isNotNull()).withColumn("copy", F.row_number().over(Window.partitionBy(key).orderBy("tokens")) - 1)
    sizes = F.array(*(F.struct(F.lit(name).alias("container"), F.lit(c).alias("capacity")) for name, c in capacities))
    each = numbered.select(key, "copy", "tokens", F.explode(sizes).alias("c")).select(key, "copy", "tokens", "c.container", "c.capacity")
    n = F.ceil(F.col("tokens") / F.col("capacity")).cast("int")
    each = each.withColumn("piece", F.explode(F.sequence(F.lit(0), n - 1)))
    start = F.col("piece").cast("long") * F.col("capacity")
    return each.select("container", "capacity", key, "copy", "piece", start.alias("from_token"), F.least(F.col("tokens") - start, F.col("capacity").cast("long")).cast("int").alias("size"))


def _capacities(capacities: DataFrame) -> list[tuple[str, int]]:
    """The container sizes, at most ``CONTAINERS``."""
    rows = capacities.filter("capacity > 0 and container is not null").select("container", "capacity").distinct().orderBy("container", "capacity").limit(CONTAINERS + 1).collect()
    if len(rows) > CONTAINERS:
        raise ValueError(f"more than {CONTAINERS} container sizes")
    return [(r["container"], r["capacity"]) for r in rows]


PLACES = "container string, capacity int, container_no long, slot int, start int, {key}, copy int, piece int, from_token long, tokens int, context int, step long"


def packed(sized: DataFrame, capacities: DataFrame, key: str = "doc_id", group: int = GROUP) -> DataFrame:
    """Each piece's place: (container, capacity, container_no, slot, start, key, copy, piece, from_token, tokens, context, step).
    ``capacities`` has the columns container and capacity; container numbers count from 0 within each size; ``context`` is the
    context size that the piece is routed to."""
    names = _capacities(capacities)
    schema = PLACES.format(key=f"`{key}` {sized.schema[key].dataType.simpleString()}")
    if not names:
        return sized.sparkSession.createDataFrame([], schema)
    rows = checkpointed(pieces(sized, names, key))
    histogram: dict[int, dict[int, int]] = defaultdict(dict)
    for r in rows.groupBy("capacity", "size").count().collect():  # at most the sum of the capacities
        histogram[r["capacity"]][r["size"]] = r["count"]
    sharing: dict[int, int] = defaultdict(int)
    for _, c in names:
        sharing[c] += 1
    plans = {c: Plan(c, {x: n // sharing[c] for x, n in h.items()}) for c, h in histogram.items()}
    salts = {(c, x): -(-n // HOT) for c, h in histogram.items() for x, n in h.items() if n > HOT}
    salted = rows.withColumn("salt", F.lit(0))
    if salts:
        hot = rows.sparkSession.createDataFrame([(c, x, n) for (c, x), n in salts.items()], "capacity int, size int, salts int")  # at most the sum of the capacities
        salted = rows.join(F.broadcast(hot), ["capacity", "size"], "left").withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(key, "copy", "piece"), F.col("salts"))).cast("int")).drop("salts")
    part = ["container", "capacity", "size", "salt"]
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*part).orderBy(key, "copy", "piece")) - 1)
    if salts:
        before = salted.filter("salt >= 0").groupBy(*part).count()
        before = before.withColumn("before", F.sum("count").over(Window.partitionBy("container", "capacity", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).drop("count")
        ranked = ranked.join(before, part).withColumn("rank", F.col("rank") + F.coalesce("before", F.lit(0))).drop("before")
    shared = rows.sparkSession.sparkContext.broadcast(plans)  # bounded by the capacities, not by the texts

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = len(pdf)
            number, slot, start = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            step, context = np.zeros(n, np.int64), np.zeros(n, np.int64)
            capacity, size, rank = pdf["capacity"].to_numpy(), pdf["size"].to_numpy(), pdf["rank"].to_numpy().astype(np.int64)
            for c in np.unique(capacity):
                plan = shared.value[int(c)]
                here = capacity == c
                ways = np.array(contexts(int(c))[::-1])
                context[here] = ways[np.searchsorted(ways, size[here])]
                for x in np.unique(size[here]):
                    i = np.nonzero(here & (size == x))[0]
                    number[i], slot[i], start[i] = plan.look_up(int(x), rank[i])
                groups = -(-plan.containers // group)
                turn, place_ = number[here] // groups, number[here] % groups
                step[here] = np.where(turn % 2 == 0, place_, groups - 1 - place_)
            yield pdf.assign(container_no=number, slot=slot.astype(np.int32), start=start.astype(np.int32), step=step, context=context.astype(np.int32))[out].rename(columns={"size": "tokens"})

    out = ["container", "capacity", "container_no", "slot", "start", key, "copy", "piece", "from_token", "size", "context", "step"]
    return ranked.mapInPandas(place, schema)


def report(places: DataFrame) -> DataFrame:
    """(container, capacity, context, containers, tokens, used, step_low, step_high) by the context size a container was opened for,
    that of its longest text, and with context null for all: how full the containers are and how even the step groups."""
    boxes = places.groupBy("container", "capacity", "container_no").agg(F.max("context").alias("context"), F.sum("tokens").alias("t"), F.first("step").alias("step"))
    tiers = boxes.groupBy("container", "capacity", "context").agg(F.count("*").alias("n"), F.sum("t").alias("t")).withColumns({"low": F.lit(None).cast("long"), "high": F.lit(None).cast("long")})
    steps = boxes.groupBy("container", "capacity", "step").agg(F.count("*").alias("n"), F.sum("t").alias("t"))
    whole = steps.groupBy("container", "capacity").agg(F.sum("n").alias("n"), F.sum("t").alias("t"), F.min("t").alias("low"), F.max("t").alias("high")).withColumn("context", F.lit(None).cast("int"))
    return tiers.unionByName(whole).select("container", "capacity", "context", F.col("n").alias("containers"), F.col("t").alias("tokens"), (F.col("t") / (F.col("n") * F.col("capacity"))).alias("used"), F.col("low").alias("step_low"), F.col("high").alias("step_high"))
