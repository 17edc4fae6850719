"""Problem 8: mixing sources to target weights, by Pareto order sampling.

A source is to give its share of the budget, at most ``max_repeats`` times its own size; where the cap binds, the total
falls short and the report shows the actual shares.  Documents are wanted with unequal expected numbers of copies, in
proportion to the square root of their size class (long documents a little more often), scaled so that the tokens come out.
The whole part of that number is allocated for certain; the rest is an inclusion probability p, and documents are ranked by
their random odds u / (1 - u) divided by their inclusion odds p / (1 - p).  The first in that order are taken until the
source's tokens are reached as nearly as possible.  The random number is a hash of the id, the mix and a seed, so a run can
be repeated anywhere.

The boundary in the order is found without collecting or sorting a source: tokens are summed over bins of the rank's
logarithm (at most ``BINS`` a source and mix), and only the rows of one bin are put in order.

Edge cases: documents without tokens, source or key aren't used; a source without documents gives nothing and stays in the
report; a document that is stored twice counts as two; shares need not sum to 1; ties of rank go to the smaller id.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from raqim.session import checkpointed

BINS, SCALE = 1 << 14, 200.0
SEED = 42
#: Rows of the table of targets; plans, edges and shares have as many, and some 30 times as many size classes, and are broadcast.
TARGETS = 10_000


def _copies(classes: list[tuple[int, int, int]], tokens: float, most: int) -> dict[int, float]:
    """Expected copies of a document of each size class (class, documents, tokens), at most ``most``, ``tokens`` in all."""
    total = sum(t for _, _, t in classes)
    if not total or tokens <= 0:
        return {c: 0.0 for c, _, _ in classes}
    if tokens >= most * total:
        return {c: float(most) for c, _, _ in classes}
    weight = {c: 2 ** (c / 2) for c, _, _ in classes}
    low, high = 0.0, most / min(weight.values())
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(most, mid * weight[c]) * t for c, _, t in classes) < tokens:
            low = mid
        else:
            high = mid
    return {c: min(float(most), high * weight[c]) for c, _, _ in classes}


def mixed(sized: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", seed: int = SEED) -> DataFrame:
    """(mix_name, source, key, copies, tokens) of each document a mix uses; ``tokens`` is the document's size."""
    docs = checkpointed(sized.filter(F.col(source).isNotNull() & F.col(key).isNotNull() & (F.col("tokens") > 0)).select(F.col(key).alias("id"), F.col(source).alias("source"), "tokens", F.floor(F.log2("tokens")).cast("int").alias("class")))
    spark = docs.sparkSession
    classes: dict[str, list[tuple[int, int, int]]] = {}
    for r in docs.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect():  # some 30 classes a source
        classes.setdefault(r["source"], []).append((r["class"], r["n"], r["t"]))
    plan, rest = [], {}
    wanted_rows = targets.select("mix_name", "source", "target_share", "max_repeats", "budget_tokens").distinct().limit(TARGETS + 1).collect()
    if len(wanted_rows) > TARGETS:
        raise ValueError(f"more than {TARGETS} rows of targets")
    for r in wanted_rows:
        own = classes.get(r["source"], [])
        c = _copies(own, (r["target_share"] or 0) * (r["budget_tokens"] or 0), max(0, r["max_repeats"] or 0))
        left = 0.0
        for k, _, t in own:
            whole = math.floor(c[k] + 1e-9)
            p = max(0.0, c[k] - whole)
            left += p * t
            if c[k] > 0:
                plan.append((r["mix_name"], r["source"], k, whole, p))
        rest[r["mix_name"], r["source"]] = left
    wanted = spark.createDataFrame(plan or [("", "", 0, 0, 0.0)], "mix_name string, source string, class int, whole int, p double")
    rows = docs.join(F.broadcast(wanted), ["source", "class"])  # a row per mix, source and size class
    u = (F.pmod(F.xxhash64("id", "mix_name", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    odds = F.log(u / (1 - u)) - F.log(F.col("p") / (1 - F.col("p")))
    ranked = rows.withColumn("rank", F.when(F.col("p") > 1e-9, odds))
    ranked = ranked.withColumn("bin", F.greatest(F.lit(-BINS // 2), F.least(F.lit(BINS // 2), F.floor(F.col("rank") * SCALE))).cast("int"))
    bins: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for r in ranked.filter("bin is not null").groupBy("mix_name", "source", "bin").agg(F.sum("tokens").alias("t")).collect():  # at most BINS + 1 a mix and source
        bins.setdefault((r["mix_name"], r["source"]), []).append((r["bin"], r["t"]))
    edges = []
    for (mix, name), items in bins.items():
        left = rest[mix, name]
        edge = BINS
        for b, t in sorted(items):
            if t > left:
                edge = b
                break
            left -= t
        edges.append((mix, name, edge, float(left)))
    cut = spark.createDataFrame(edges or [("", "", 0, 0.0)], "mix_name string, source string, edge int, room double")
    placed = ranked.join(F.broadcast(cut), ["mix_name", "source"], "left")
    order = Window.partitionBy("mix_name", "source").orderBy("rank", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge_rows = placed.filter("bin = edge").withColumn("extra", (F.sum("tokens").over(order) <= F.col("room")).cast("int"))
    others = placed.filter("bin is null or bin <> edge").withColumn("extra", F.coalesce((F.col("bin") < F.col("edge")).cast("int"), F.lit(0)))
    chosen = checkpointed(others.unionByName(edge_rows).select("mix_name", "source", "id", "tokens", "whole", "p", "rank", "extra"))
    # what the order leaves short is filled by the one document that comes nearest to it; of equal ones, the first in the order
    short = {key: rest[key] for key in bins}
    for r in chosen.filter("extra = 1").groupBy("mix_name", "source").agg(F.sum("tokens").alias("t")).collect():
        short[r["mix_name"], r["source"]] -= r["t"]
    missing = spark.createDataFrame([(m, n, float(x)) for (m, n), x in short.items()] or [("", "", 0.0)], "mix_name string, source string, short double")
    off = F.abs(F.col("tokens") - F.col("short"))
    last = chosen.filter("extra = 0 and rank is not null").join(F.broadcast(missing), ["mix_name", "source"]).filter(off < F.col("short"))
    last = last.groupBy("mix_name", "source").agg(F.min(F.struct(off.alias("off"), "rank", "id")).alias("m")).select("mix_name", "source", F.col("m.id").alias("id"), F.lit(1).alias("more"))
    final = chosen.join(F.broadcast(last), ["mix_name", "source", "id"], "left").withColumn("copies", F.col("whole") + F.col("extra") + F.coalesce("more", F.lit(0)))
    return final.filter("copies > 0").select("mix_name", "source", F.col("id").alias(key), "copies", "tokens")


def shares(selection: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, budget_tokens, documents, most_copies, tokens, actual_share, share_of_budget) of every target row:
    the share of what the mix holds, and of what it was to hold."""
    got = selection.groupBy("mix_name", "source").agg(F.count("*").alias("documents"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("tokens")).alias("tokens"))
    zero = F.lit(0)
    all_ = targets.select("mix_name", "source", "target_share", "budget_tokens").distinct().join(got, ["mix_name", "source"], "left")
    total = F.sum(F.coalesce("tokens", zero)).over(Window.partitionBy("mix_name"))
    share = F.when(total > 0, F.coalesce("tokens", zero) / total).otherwise(F.lit(0.0))
    return all_.select("mix_name", "source", "target_share", "budget_tokens", F.coalesce("documents", zero).alias("documents"), F.coalesce("most_copies", zero).alias("most_copies"), F.coalesce("tokens", zero).alias("tokens"), share.alias("actual_share"), (F.coalesce("tokens", zero) / F.col("budget_tokens")).alias("share_of_budget"))
