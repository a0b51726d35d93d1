"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations; a node's neighbours are never collected: its minimum is
joined back to its edges, and edges of hot nodes meet it through a balanced join. Rounds
grow with the logarithm of the longest chain and end when every node hangs on one that hangs on
none. Lineage is cut by tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgextract.operators.skew import join_counted
from orgextract.session import discard, stored


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """edges (u > v). Large star: greater neighbours of u link to u's minimum; small star: the smaller ones do."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("_n"))
    if large:
        x = join_counted(both, least, "u", "_n", total=2 * total).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        x = join_counted(both, least, "u", "_n", total=total)
        x = x.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return x.filter("u <> v").distinct()


def _one_parent(e: DataFrame) -> bool:
    return e.groupBy("u").count().filter("count > 1").isEmpty()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 40) -> DataFrame:
    """node, label: the least node of each node's component; only nodes with an edge to another."""
    e = (
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    e = stored(e, "edges")
    for _ in range(max_rounds):
        parents = e.select(F.col("v").alias("u")).distinct()
        if parents.join(e.select("u"), "u", "left_semi").isEmpty() and _one_parent(e):
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
            )
        half = stored(_star(e, True, e.count()), "edges")
        last, e = e, stored(_star(half, False, half.count()), "edges")
        discard(last)
        discard(half)
    raise RuntimeError("components did not settle")
