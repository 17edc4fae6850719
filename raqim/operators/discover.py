"""Discovery over captured documents: walks of link graphs, sitemaps in turn, and what a site's run adds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raqim.functions import robots
from raqim.session import checkpointed

#: Most sitemaps of a site that a run reads, and most pages of a site.
SITEMAPS, PAGES = 2000, 50_000
#: Levels of a walk that are kept as tables of their own before they are put together.
MERGE = 16


def _first(levels: list[DataFrame]) -> DataFrame:
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def reach(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(root, node, depth): breadth-first from ``start`` (root, node) over ``edges`` (parent, child) until nothing new is met; each node at
    its least depth.  Each level is written once; a cycle is cut where it returns to a node."""
    frontier = checkpointed(start.select("root", "node").distinct().withColumn("depth", F.lit(0)))
    levels, depth = [frontier], 0
    while not frontier.isEmpty():
        depth += 1
        step = frontier.join(edges, frontier["node"] == edges["parent"]).select("root", F.col("child").alias("node")).distinct()
        for level in levels:
            step = step.join(level.select("root", "node"), ["root", "node"], "left_anti")
        frontier = checkpointed(step.withColumn("depth", F.lit(depth)))
        levels.append(frontier)
        if len(levels) == MERGE:  # few anti-joins: what is older stands in one table
            levels = [checkpointed(_first(levels))]
    return _first(levels)


def best_first(links: DataFrame, start: DataFrame, visits: int = 10, most_depth: int = 2) -> DataFrame:
    """(root, node, depth, visit): per root, the order in which pages are visited, at most ``visits``: the start, then always the page of
    the highest score among all that were met so far, at whatever depth; of equal scores the one met first.  Pages at ``most_depth``
    lead no further.  ``links`` has parent, child, score and rank, the order of a page's links.  All roots take a step at a time."""
    frontier = start.select("root", "node").distinct().withColumns({"depth": F.lit(0), "score": F.lit(0), "met": F.lit(0), "rank": F.lit(0)})
    frontier = checkpointed(frontier)
    visited = frontier.limit(0).select("root", "node", "depth").withColumn("visit", F.lit(0))
    met = checkpointed(frontier.select("root", "node"))
    order = Window.partitionBy("root").orderBy(F.desc("score"), "met", "rank", "node")
    for visit in range(1, visits + 1):
        ordered = frontier.withColumn("nth", F.row_number().over(order))
        now = checkpointed(ordered.filter("nth = 1").drop("nth"))
        if now.isEmpty():
            break
        visited = visited.unionByName(now.select("root", "node", "depth").withColumn("visit", F.lit(visit)))
        step = now.filter(F.col("depth") < most_depth).select("root", F.col("node").alias("parent"), "depth").join(links.select("parent", F.col("child").alias("node"), "score", "rank"), "parent")
        step = step.groupBy("root", "node").agg((F.max("depth") + 1).alias("depth"), F.max("score").alias("score"), F.min("rank").alias("rank")).withColumn("met", F.lit(visit))
        step = checkpointed(step.join(met, ["root", "node"], "left_anti"))
        met = met.union(step.select("root", "node"))
        frontier = checkpointed(ordered.filter("nth > 1").drop("nth").unionByName(step))
    return visited


def chosen_sites(sites: DataFrame, resume: bool = False, limit: int | None = 1) -> DataFrame:
    """The sites to discover next: pending ones before those without pages (and incomplete ones, where ``resume``), by id."""
    wanted = ["pending", "not_pages"] + (["incomplete"] if resume else [])
    ordered = sites.filter(F.col("crawl_status").isin(wanted)).orderBy(F.when(F.col("crawl_status") == "pending", 0).otherwise(1), "id")
    return ordered if limit is None else ordered.limit(limit)


def sitemap_walk(seeds: DataFrame, documents: DataFrame, listed: DataFrame, rules: DataFrame | None = None, most: int = SITEMAPS) -> DataFrame:
    """(site_id, url, turn, outcome, reason): each site's sitemaps in the order of a queue, up to ``most`` of them: the seeds
    (site_id, url, pos), then what each lists, in turn.  A sitemap that is refused or was not read lists nothing.  Feeds are walked alike.  ``documents``: (url, ok, reason) of captured fetches; ``listed``: (url, format, pos, kind, target)
    of what they hold; ``rules``: robots rules with site_id.  A queue works level by level, so a level is one step for all sites."""
    read = documents.filter("ok").select(F.col("url").alias("parent"))
    nested = listed.filter("kind = 'sitemap'").select(F.col("url").alias("parent"), F.col("target").alias("url"), "pos").join(read, "parent", "left_semi")
    judged = lambda df: robots.allowed(df, rules, "site_id") if rules is not None else df.withColumn("allowed", F.lit(True))
    level = checkpointed(judged(seeds.groupBy("site_id", "url").agg(F.min(F.array(F.col("pos").cast("long"))).alias("at"))))
    levels = [level]
    while not level.isEmpty():
        step = level.filter("allowed").select("site_id", F.col("url").alias("parent"), F.col("at").alias("before")).join(nested, "parent")
        step = step.groupBy("site_id", "url").agg(F.min(F.concat("before", F.array(F.col("pos").cast("long")))).alias("at"))
        for seen in levels:
            step = step.join(seen.select("site_id", "url"), ["site_id", "url"], "left_anti")
        level = checkpointed(judged(step))
        levels.append(level)
    all_ = _first([x.withColumn("level", F.lit(i)) for i, x in enumerate(levels)])
    turn = F.row_number().over(Window.partitionBy("site_id").orderBy("level", "at", "url"))
    taken = all_.withColumn("turn", turn).filter(F.col("turn") <= most)
    formats = listed.groupBy("url").agg(F.first("format", ignorenulls=True).alias("format"))
    known = taken.join(documents.select("url", "ok", F.col("reason").alias("why")), "url", "left").join(formats, "url", "left")
    valid = F.coalesce("format", F.lit("")) != ""
    ok = F.coalesce("ok", F.lit(False))
    outcome = F.when(~F.col("allowed"), "skipped").when(~ok, "failed").when(~valid, "invalid").otherwise("parsed")
    reason = F.when(~F.col("allowed"), "robots_disallowed").when(~ok, F.coalesce("why", F.lit("not_captured"))).when(~valid, "unrecognized_sitemap_format")
    return known.select("site_id", "url", "turn", outcome.alias("outcome"), reason.alias("reason"))


def found_pages(walk: DataFrame, listed: DataFrame, known: DataFrame | None = None, rules: DataFrame | None = None, most: int = PAGES) -> DataFrame:
    """(site_id, url, turn, pos): new pages of the parsed documents of a walk, each once where it is met first, without those that robots
    rules refuse or that ``known`` (site_id, url) holds, up to ``most`` a site in all."""
    pages = walk.filter("outcome = 'parsed'").select("site_id", F.col("url").alias("document"), "turn")
    listed_pages = listed.filter("kind = 'page'").select(F.col("url").alias("document"), F.col("target").alias("url"), "pos")
    pages = pages.join(listed_pages, "document").groupBy("site_id", "url").agg(F.min(F.struct("turn", "pos")).alias("at")).select("site_id", "url", "at.turn", "at.pos")
    if rules is not None:
        pages = robots.allowed(pages, rules, "site_id").filter("allowed").select("site_id", "url", "turn", "pos")
    had = None
    if known is not None:
        pages = pages.join(known.select("site_id", "url"), ["site_id", "url"], "left_anti")
        had = known.groupBy("site_id").agg(F.count("*").alias("accepted"))
    from raqim.operators.queue import capped

    return capped(pages, most, "site_id", ("turn", "pos", "url"), had).drop("left")


def runs(sites: DataFrame, walk: DataFrame, pages: DataFrame, denied: DataFrame | None = None, known: DataFrame | None = None, most: int = PAGES, sitemaps: int = SITEMAPS) -> DataFrame:
    """(site_id, status, reason, sitemaps, valid_sitemaps, pages_added, pages_total, feeds_wanted) of each site's run.  A site whose robots file could not be
    read (``denied``: site_id) stays pending; at most one added page asks for the feeds, and without them for a browser."""
    from raqim.operators.queue import final_status

    w = walk.groupBy("site_id").agg(F.count("*").alias("sitemaps"), F.count_if(F.col("outcome") == "parsed").alias("valid_sitemaps"))
    p = pages.groupBy("site_id").agg(F.count("*").alias("pages_added"))
    all_ = sites.select(F.col("id").alias("site_id")).join(w, "site_id", "left").join(p, "site_id", "left")
    zero: Column = F.lit(0)
    had = known.groupBy("site_id").agg(F.count("*").alias("had")) if known is not None else None
    all_ = all_.join(had, "site_id", "left") if had is not None else all_.withColumn("had", zero)
    blocked = denied.select("site_id", F.lit(True).alias("blocked")).distinct() if denied is not None else None
    all_ = all_.join(blocked, "site_id", "left") if blocked is not None else all_.withColumn("blocked", F.lit(False))
    added, total, n = F.coalesce("pages_added", zero), F.coalesce("pages_added", zero) + F.coalesce("had", zero), F.coalesce("sitemaps", zero)
    off = F.coalesce("blocked", F.lit(False))
    status = F.when(off, "pending").otherwise(final_status(total > 0, total >= most, (n >= sitemaps) | (total >= most)))
    return all_.select(
        "site_id", status.alias("status"), F.when(off, "robots_txt_unreachable_fail_closed").alias("reason"), F.when(off, zero).otherwise(n).alias("sitemaps"), F.when(off, zero).otherwise(F.coalesce("valid_sitemaps", zero)).alias("valid_sitemaps"),
        F.when(off, zero).otherwise(added).alias("pages_added"), total.alias("pages_total"), (~off & (added <= 1) & (total < most)).alias("feeds_wanted"),
    )
