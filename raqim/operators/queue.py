"""The crawl queue: picking batches, leases, outcomes, limits per site and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raqim.session import checkpointed


def acquire(queue: DataFrame, limit: int, attempts: int = 2) -> DataFrame:
    """The next batch, rows as they were before it: pending or queued rows by id (rows in process count as pending again); if there
    are none, rows to review with fewer than ``attempts`` attempts."""
    status = F.coalesce(F.col("crawl_status"), F.lit("pending"))
    tier = F.when(status.isin("pending", "queued", "processing"), 1).when((status == "needs_review") & (F.coalesce("crawl_attempts", F.lit(0)) < attempts), 2)
    tiered = queue.withColumn("tier", tier).filter("tier is not null")
    # the limit is the feature: each tier is cut to it before the better one is chosen
    top = tiered.orderBy("tier", "id").limit(limit)
    best = top.agg(F.min("tier").alias("best"))
    return top.join(F.broadcast(best), F.col("tier") == F.col("best")).withColumn("phase", F.when(F.col("tier") == 1, "pending").otherwise("review")).drop("tier", "best")


def mark(queue: DataFrame, batch: DataFrame) -> DataFrame:
    """The queue after the batch was taken: its rows in process with one attempt more, others in process pending again."""
    taken = batch.select("id", F.lit(True).alias("taken")).distinct()
    joined = queue.join(taken, "id", "left")
    reset = F.when(F.col("crawl_status") == "processing", "pending").otherwise(F.col("crawl_status"))
    more = F.coalesce("crawl_attempts", F.lit(0)) + F.when(F.coalesce("taken", F.lit(False)), 1).otherwise(0)
    return joined.withColumn("crawl_status", F.when(F.col("taken"), "processing").otherwise(reset)).withColumn("crawl_attempts", more.cast("int")).drop("taken")


def claim(queue: DataFrame, limit: int, worker: str, shard: int = 0, shards: int = 1) -> DataFrame:
    """Rows for a worker, at most 2000 by id.  Workers of different shards never take the same row, whatever the time."""
    own = queue.filter(F.col("crawl_status").isin("pending", "queued") & (F.pmod(F.xxhash64("url"), F.lit(shards)) == shard))
    return own.orderBy("id").limit(max(1, min(limit, 2000))).withColumn("worker_id", F.lit(worker)).withColumn("crawl_status", F.lit("processing")).withColumn("crawl_attempts", F.col("crawl_attempts") + 1)


def finish(queue: DataFrame, done: DataFrame) -> DataFrame:
    """The queue with the status of ``done`` (id, status) set and its leases cleared."""
    joined = queue.join(done.select("id", F.col("status").alias("new__")), "id", "left")
    over = F.col("new__").isNotNull()
    return joined.withColumn("crawl_status", F.coalesce("new__", "crawl_status")).withColumn("worker_id", F.when(~over, F.col("worker_id"))).withColumn("processing_started_at", F.when(~over, F.col("processing_started_at"))).drop("new__")


def is_stale(now: Column, minutes: int = 30) -> Column:
    """A lease older than so many minutes, at least one."""
    return (F.col("crawl_status") == "processing") & (F.col("processing_started_at") < now - F.make_interval(mins=F.lit(max(1, minutes))))


def recover(queue: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """The queue with stale leases pending again, and ``recovered`` telling which."""
    gone = F.coalesce(is_stale(now, minutes), F.lit(False))
    out = queue.withColumn("recovered", gone)
    return out.withColumn("crawl_status", F.when(F.col("recovered"), "pending").otherwise(F.col("crawl_status"))).withColumn("worker_id", F.when(~F.col("recovered"), F.col("worker_id"))).withColumn("processing_started_at", F.when(~F.col("recovered"), F.col("processing_started_at")))


def outcome(complete: Column, phase: Column, attempts: Column, retries: int = 1) -> Column:
    """indexed, needs_review, or corrupt: in review already or out of attempts."""
    return F.when(complete, "indexed").when((phase == "review") | (F.coalesce(attempts, F.lit(0)) >= retries + 1), "corrupt").otherwise("needs_review")


def _numbered(events: DataFrame, order: str) -> DataFrame:
    """``events`` with n, their place in the order, and of, their number, without one task that sees them all: each partition of a sort
    by ranges counts for itself and starts where those before it end."""
    parts = checkpointed(events.repartitionByRange(F.col(order)).withColumn("part__", F.spark_partition_id()))
    counts = parts.groupBy("part__").agg(F.count("*").alias("c"))  # a row a partition
    start = counts.select("part__", (F.sum("c").over(Window.orderBy("part__")) - F.col("c")).alias("start__"), F.sum("c").over(Window.partitionBy()).alias("of"))
    inside = F.row_number().over(Window.partitionBy("part__").orderBy(order))
    return parts.join(F.broadcast(start), "part__").withColumn("n", F.col("start__") + inside).drop("part__", "start__")


def milestones(events: DataFrame, order: str, step: int = 20, group: str | None = None) -> DataFrame:
    """The events at which progress passes a multiple of ``step`` per cent: with n, of and percent.  Per group, where one is named."""
    if group:
        part = Window.partitionBy(group)
        numbered = events.withColumn("n", F.row_number().over(part.orderBy(order))).withColumn("of", F.count("*").over(part))
    else:
        numbered = _numbered(events, order)
    percent = lambda n: F.floor(100 * n / F.col("of")).cast("int")
    reached = lambda n: F.floor(percent(n) / step)
    return numbered.withColumn("percent", percent(F.col("n"))).filter(reached(F.col("n")) > reached(F.col("n") - 1))


#: Groups into which a site's pages are cut before the limit is applied.
SALTS = 32


def capped(pages: DataFrame, limit: int, site: str = "site_id", order: tuple[str, ...] = ("pos",), accepted: DataFrame | None = None) -> DataFrame:
    """Pages of each site up to its limit, less what was accepted before (site, accepted); with ``left``, how many stay behind."""
    # each salt of a site gives no more than the limit, so no task holds a whole hot site
    salted = pages.withColumn("salt__", F.pmod(F.xxhash64(*order), F.lit(SALTS)))
    few = salted.withColumn("n", F.row_number().over(Window.partitionBy(site, "salt__").orderBy(*order))).filter(F.col("n") <= limit).drop("n", "salt__")
    numbered = few.withColumn("n", F.row_number().over(Window.partitionBy(site).orderBy(*order))).filter(F.col("n") <= limit)
    numbered = numbered.join(pages.groupBy(site).agg(F.count("*").alias("all")), site)
    if accepted is not None:
        numbered = numbered.join(accepted.select(site, "accepted"), site, "left")
    else:
        numbered = numbered.withColumn("accepted", F.lit(0))
    room = F.greatest(F.lit(limit) - F.coalesce("accepted", F.lit(0)), F.lit(0))
    return numbered.withColumn("left", F.greatest(F.col("all") - room, F.lit(0)).cast("long")).filter(F.col("n") <= room).drop("n", "all", "accepted")


def final_status(found: Column, cap_reached: Column, work_left: Column) -> Column:
    return F.when(~found, "not_pages").when(cap_reached & work_left, "incomplete").otherwise("completed")
