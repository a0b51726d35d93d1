from pyspark.sql import functions as F

from orgextract.operators.snapshots import snapshot_diff


def test_changes(spark):
    rows = spark.createDataFrame(
        [(1, 1, "a", "x"), (1, 1, "b", "y"), (1, 1, "c", "z"), (1, 1, "c", "z"), (1, 3, "a", "x"), (1, 3, "b", "q"), (1, 3, "d", None),
         (1, 3, None, "n"), (1, 2, "zz", "failed"), (2, 1, "a", "x")],
        "f int, r int, k string, v string",
    )
    runs = spark.createDataFrame([(1, 1), (1, 3), (1, 4), (2, 1)], "f int, r int")
    got = snapshot_diff(rows, runs, "f", "r", "k", F.coalesce("v", F.lit("")))
    assert sorted(tuple(x) for x in got.collect()) == [
        (1, 3, "b", "changed"), (1, 3, "c", "removed"), (1, 3, "d", "added"), (1, 4, "a", "removed"), (1, 4, "b", "removed"), (1, 4, "d", "removed"),
    ]


def test_same_set_in_other_rows_is_unchanged(spark):
    rows = spark.createDataFrame([(1, 1, "k", "a"), (1, 1, "k", "b"), (1, 2, "k", "b"), (1, 2, "k", "a"), (1, 2, "k", "a")], "f int, r int, k string, v string")
    runs = spark.createDataFrame([(1, 1), (1, 2)], "f int, r int")
    assert snapshot_diff(rows, runs, "f", "r", "k", F.col("v")).count() == 0


def test_empty(spark):
    rows = spark.createDataFrame([], "f int, r int, k string, v string, extra string")
    runs = spark.createDataFrame([], "f int, r int")
    assert snapshot_diff(rows, runs, "f", "r", "k", F.col("v")).count() == 0
