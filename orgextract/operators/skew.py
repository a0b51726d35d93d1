"""Joins that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys above 1/HOT_SHARE of all rows number fewer than HOT_SHARE: a proven bound for broadcasting.
HOT_SHARE = 2000
LEAST_HOT = 1000


#: Rows of a short list (runs, feeds, positions) that may be broadcast.
SHORT_LIST = 100_000


def short_list(df: DataFrame, limit: int = SHORT_LIST) -> DataFrame:
    """df marked for broadcast if its counted size allows; a longer one is left to a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, count: str, how: str = "inner", total: int | None = None) -> DataFrame:
    """rows joined (inner or left) with a table of one row per key that carries the key's row count.

    Keys with more than 1/HOT_SHARE of the counted rows are broadcast, the others meet in a
    shuffle in which none exceeds that share. Null keys find nothing. `total`, the sum of the
    counts, spares a pass where the caller knows it.
    """
    if total is None:
        total = keyed.agg(F.sum(count)).first()[0] or 0
    limit = max(total // HOT_SHARE, LEAST_HOT)
    hot = F.broadcast(keyed.filter(F.col(count) > limit).drop(count).withColumn("_hot", F.lit(True)))
    cold = keyed.filter(F.col(count) <= limit).drop(count)
    first = rows.join(hot, key, "left")
    found = first.filter("_hot").drop("_hot")
    rest = first.filter("_hot IS NULL").select(*rows.columns)
    if how == "left":
        none = rest.filter(F.col(key).isNull())
        other = rest.filter(F.col(key).isNotNull()).join(cold, key, "left")
        return found.unionByName(other).unionByName(none, allowMissingColumns=True)
    return found.unionByName(rest.join(cold, key))


#: The share of right's rows on which hot keys are told.
SAMPLE = 16


def join_split(left: DataFrame, right: DataFrame, keys: list[str], least: int = LEAST_HOT, sample: int = SAMPLE) -> DataFrame:
    """left joined with right on keys where both sides may hold many rows of one key (an inner join, many to many).

    A key with more than `least` of right's rows is cut into slices of about that size: its right rows
    are dealt over the slices, its left rows meet every slice, so its pairs are formed in many tasks.
    All rows take part; only which keys are cut is told on a part of them, and of these the 2 * HOT_SHARE
    most frequent (every key with a larger share than 1/HOT_SHARE is among them), so their list is of
    bounded size. Where no key is hot the join is a plain one. Null keys find nothing.
    """
    seen = right.filter(F.pmod(F.xxhash64(*right.columns), F.lit(sample)) == 0).groupBy(*keys).agg((F.count("*") * sample).alias("_n"))
    top = seen.filter(F.col("_n") > least / 2).orderBy(F.desc("_n"), *keys).limit(2 * HOT_SHARE)
    top = top.select(*keys, F.ceil(F.col("_n") / least).cast("int").alias("_slices"))
    rows = top.collect()
    if not rows:
        return left.join(right, keys)
    hot = F.broadcast(right.sparkSession.createDataFrame(rows, top.schema))
    deal = F.when(F.col("_slices").isNotNull(), F.pmod(F.xxhash64(*right.columns), F.col("_slices"))).otherwise(0)
    dealt = right.join(hot, keys, "left").withColumn("_slice", deal.cast("int"))
    spread = left.join(hot, keys, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
    return spread.drop("_slices").join(dealt.drop("_slices"), [*keys, "_slice"]).drop("_slice")
