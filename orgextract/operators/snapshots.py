"""Changes between consecutive full snapshots (problem 5).

EXCEPT ALL in both directions removes the rows two snapshots share; the residues are
joined in full by key and labelled. All pairs of consecutive snapshots run in one plan:
each row is placed against its own run (as "now") and, shifted, against the next good
run (as "before"), so no loop over runs is needed and equal rows cancel in one shuffle.

A key present twice in one snapshot counts as present; it is `changed` only if its sets of
values differ (a value delivered twice in one run is one value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orgextract.operators.skew import short_list


def consecutive_runs(runs: DataFrame, stream: str, order: str) -> DataFrame:
    """(stream, order, previous order) of good runs; the first run of a stream has a null previous.

    The run list is metadata with one row per snapshot, not per record.
    """
    w = Window.partitionBy(stream).orderBy(order)
    return runs.select(stream, order).distinct().withColumn("_prev", F.lag(order).over(w))


def snapshot_diff(rows: DataFrame, runs: DataFrame, stream: str, order: str, key: str, value: Column) -> DataFrame:
    """stream, order, key, change_kind for every run that has a predecessor.

    `rows` hold stream, order, key and whatever `value` needs. Null keys are dropped.
    Empty input gives an empty result; extra columns are ignored.
    """
    pairs = consecutive_runs(runs, stream, order).filter(F.col("_prev").isNotNull())
    slim = rows.filter(F.col(key).isNotNull()).select(
        F.col(stream).alias("_s"), F.col(order).alias("_o"), F.col(key).alias("_k"), F.struct(value.alias("v")).alias("_v")
    )  # in a struct, so that null equals null
    p = short_list(pairs.select(F.col(stream).alias("_ps"), F.col(order).alias("_run"), "_prev"))
    now = slim.join(p, (F.col("_s") == F.col("_ps")) & (F.col("_o") == F.col("_run"))).select("_s", "_run", "_k", "_v")
    before = slim.join(p, (F.col("_s") == F.col("_ps")) & (F.col("_o") == F.col("_prev"))).select("_s", "_run", "_k", "_v")
    by_key, whole = ["_s", "_run", "_k"], ["_s", "_run", "_k", "_v"]

    def residue_of(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        """Keys with rows of a beyond those of b; a further copy of a value that b holds is none."""
        beyond = a.exceptAll(b).distinct().join(b, whole, "left_anti")
        return beyond.select(*by_key).distinct().withColumn(name, F.lit(True))

    gained, lost = residue_of(now, before, "_gained"), residue_of(before, now, "_lost")
    residue = gained.join(lost, by_key, "full")
    # A key with residue on one side only may still stand, unchanged in another row, on both sides.
    in_now = now.select(*by_key).distinct().withColumn("_in_now", F.lit(True))
    in_before = before.select(*by_key).distinct().withColumn("_in_before", F.lit(True))
    kind = (
        F.when(F.col("_in_before").isNull(), "added").when(F.col("_in_now").isNull(), "removed").otherwise("changed")
    )
    return (
        residue.join(in_now, by_key, "left")
        .join(in_before, by_key, "left")
        .select(F.col("_s").alias(stream), F.col("_run").alias(order), F.col("_k").alias(key), kind.alias("change_kind"))
    )
