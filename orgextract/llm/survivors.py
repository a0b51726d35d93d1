"""One surviving record per group, chosen field by field from skyline layers (problem 6).

Records are compared in three dimensions: completeness of the field, trust in the source
and recency. Of records alike in completeness and trust only the latest can be undominated,
so records are first reduced, map-side, to one per cell (completeness x trust x catalogue
entry); what is collected per group is bounded by the number of cells, however many records
the group has. Within the cells dominance layers are peeled: a lexicographic policy picks
from the first layer, and a field still empty is filled from the next one.

Defined results
* a group without any usable value in a field has null there;
* ties in all dimensions go to the later record, then the larger id, then the greater text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cells(df: DataFrame, key: str, complete: Column, trust: Column, entry: Column, recency: Column, rid: str, value: Column) -> DataFrame:
    """key, cells: array<struct(complete, trust, seen, rid, n, value)>, at most one per (complete, trust, entry)."""
    x = df.select(
        F.col(key), complete.alias("complete"), trust.alias("trust"), entry.alias("entry"), recency.alias("seen"),
        F.col(rid).alias("rid"), value.alias("value"),
    ).filter("complete > 0")
    one = x.groupBy(key, "complete", "trust", "entry").agg(
        F.count("*").alias("n"), F.max(F.struct("seen", "rid", "value")).alias("top")
    )
    return one.groupBy(key).agg(
        F.collect_list(F.struct("complete", "trust", F.col("top.seen").alias("seen"), F.col("top.rid").alias("rid"), "n", F.col("top.value").alias("value"))).alias("cells")
    )


def _dominates(a: Column, b: Column) -> Column:
    ge = (a["complete"] >= b["complete"]) & (a["trust"] >= b["trust"]) & (a["seen"] >= b["seen"])
    gt = (a["complete"] > b["complete"]) | (a["trust"] > b["trust"]) | (a["seen"] > b["seen"])
    return ge & gt


def skyline(c: Column) -> Column:
    return F.filter(c, lambda b: ~F.exists(c, lambda a: _dominates(a, b)))


def layers(df: DataFrame, column: str, depth: int) -> DataFrame:
    """Columns _layer1.._layerN: successive dominance layers of an array of cells."""
    rest = F.col(column)
    for i in range(1, depth + 1):
        df = df.withColumn(f"_layer{i}", skyline(rest)).withColumn("_rest", F.array_except(rest, F.col(f"_layer{i}")))
        rest = F.col("_rest")
    return df


def ranked(c: Column) -> Column:
    """Each cell with the number of its dominance layer, from 1, however many layers there are.

    A cell lies one layer below the deepest cell that dominates it. Sorted by their dimensions,
    cells come after all that dominate them, so one fold numbers them.
    """
    kept = lambda x: [x[k].alias(k) for k in ("complete", "trust", "seen", "rid", "n", "value")]
    ordered = F.reverse(F.array_sort(F.transform(c, lambda x: F.struct(*kept(x)))))
    none = F.filter(F.transform(c, lambda x: F.struct(F.lit(1).alias("layer"), *kept(x))), lambda x: F.lit(False))

    def add(done: Column, x: Column) -> Column:
        above = F.array_max(F.transform(F.filter(done, lambda a: _dominates(a, x)), lambda a: a["layer"]))
        return F.concat(done, F.array(F.struct((F.coalesce(above, F.lit(0)) + 1).alias("layer"), *kept(x))))

    return F.aggregate(ordered, none, add)


def pick(c: Column, policy: Callable[[Column], list[Column]]) -> Column:
    """The value of the cell that is greatest under the policy's order."""
    ranked = F.transform(c, lambda x: F.struct(*[p.alias(f"p{i}") for i, p in enumerate(policy(x))], x["value"].alias("value")))
    return F.array_max(ranked)["value"]


def from_layers(df: DataFrame, depth: int, usable: Callable[[Column], Column], policy: Callable[[Column], list[Column]]) -> Column:
    """The pick of the first layer that has a usable cell."""
    return F.coalesce(*[pick(F.filter(F.col(f"_layer{i}"), usable), policy) for i in range(1, depth + 1)])
