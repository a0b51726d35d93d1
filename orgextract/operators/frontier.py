"""Bounded link expansion as an iterative relational query (I1-I3, JN8, P16-P18)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgextract import profiles as p
from orgextract.operators.skew import join_counted
from orgextract.session import stored


def expand(
    links: DataFrame,
    seeds: DataFrame,
    depth_limit: int,
    stop: DataFrame | None = None,
    visited: DataFrame | None = None,
    site: Callable | None = None,
    finished: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """node, depth: nodes within depth_limit links of a seed, each with its least depth.

    links: (src, dst); seeds: (node) or, to go on from a saved frontier (I3), (node, depth) with the
    saved `visited` (node, depth), which isn't visited again and is part of the result. Level-synchronous:
    the frontier meets the links in one keyed join, balanced by the links' counts so that a page with a
    third of all links is split; visited nodes drop out by an anti join, each level is written to the
    shared folder. Cycles end because no node is visited twice.

    `stop` (node) isn't expanded. `finished` gives, from the nodes of a level, the sites (column site)
    that are done: their nodes are neither visited nor expanded from then on (P17); `site` is the
    site of a node as a column function.
    Null nodes are ignored; empty seeds give the saved nodes.
    """
    depth = F.col("depth") if "depth" in seeds.columns else F.lit(0)
    waiting = seeds.filter("node IS NOT NULL").groupBy("node").agg(F.min(depth).cast("int").alias("depth"))
    if visited is not None:
        visited = visited.select("node", F.col("depth").cast("int").alias("depth"))
        waiting = waiting.join(visited.select("node"), "node", "left_anti")
    waiting = stored(waiting, "frontier")
    edges = stored(links.filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select("src", "dst").distinct(), "links")
    degree = stored(edges.groupBy("src").agg(F.count("*").alias("n")), "degrees")
    total = degree.agg(F.sum("n")).first()[0] or 0
    first = waiting.agg(F.min("depth")).first()[0]
    done = None
    found_at: DataFrame | None = None
    for d in range(0 if first is None else first, depth_limit + 1):
        level = waiting.filter(F.col("depth") == d)
        if found_at is not None:
            level = level.unionByName(found_at).distinct()
        if visited is not None:
            level = level.join(visited.select("node"), "node", "left_anti")
        if done is not None:
            level = level.withColumn("site", site(F.col("node"))).join(done, "site", "left_anti").drop("site")
        level = stored(level, "frontier")
        if finished is not None:
            over = finished(level).select("site").distinct()
            done = stored(over if done is None else done.unionByName(over).distinct(), "done")
        visited = level if visited is None else visited.unionByName(level)
        if level.isEmpty() and waiting.filter(F.col("depth") > d).isEmpty():
            break
        if d == depth_limit:
            break
        sources = level if stop is None else level.join(stop.select("node"), "node", "left_anti")
        keyed = sources.select(F.col("node").alias("src")).join(degree, "src")
        found_at = join_counted(edges, keyed, "src", "n", total=total).select(F.col("dst").alias("node")).distinct().withColumn("depth", F.lit(d + 1))
    return visited if visited is not None else waiting


def senior_records(records: DataFrame) -> DataFrame:
    """Records with a senior title anywhere in the role and an address; their site is done."""
    low = F.lower(F.coalesce("role", F.lit("")))
    titles = sorted({s.lower() for s in p.SENIOR_TITLES})
    return records.filter(low.rlike("|".join(titles)) & (F.coalesce("email", F.lit("")) != ""))
