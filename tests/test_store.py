import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgextract.sources.store import Store, part_of, touched_parts

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.StringType())])


def made(spark, a, b, x):
    return spark.range(a, b).select(part_of("id", parts=8), "id", F.lit(x).alias("x"))


def test_parts_are_replaced_or_appended(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    s = Store.open(spark, path, {"parts": 8})
    assert s.version == 0 and s.read("t", SCHEMA).count() == 0
    s.write("t", made(spark, 0, 100, "a"), replace=False)
    s = s.commit()
    batch = made(spark, 100, 102, "b")
    parts = touched_parts(batch, 8)
    s.write("t", batch, replace=False)
    s = s.commit()
    assert s.read("t", SCHEMA).count() == 102
    assert s.read("t", SCHEMA, parts).select("part").distinct().count() == len(parts)
    s.write("t", batch, replace=True)
    s = s.commit()
    again = Store.open(spark, path)
    assert again.version == 3 and again.settings == {"parts": 8}
    got = again.read("t", SCHEMA)
    assert got.filter("x = 'b'").count() == 2 and got.filter(F.col("part").isin(parts) & (F.col("x") == "a")).count() == 0
    s.write("t", made(spark, 200, 300, "c"), replace=False)
    s = s.commit()
    n = s.read("t", SCHEMA).count()
    s.compact("t", SCHEMA)
    s = s.commit()
    assert s.read("t", SCHEMA).count() == n and all(len(v) == 1 for v in s.parts["t"].values())


def test_the_second_writer_of_a_version_fails(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    a, b = Store.open(spark, path), Store.open(spark, path)
    a.write("t", made(spark, 0, 10, "a"), replace=True)
    b.write("t", made(spark, 0, 20, "b"), replace=True)
    a.commit()
    with pytest.raises(RuntimeError):
        b.commit()
    assert Store.open(spark, path).read("t", SCHEMA).filter("x = 'a'").count() == 10
