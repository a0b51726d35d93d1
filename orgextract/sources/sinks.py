"""Sinks (K1-K3, K7-K10): CSV and JSON exports, appended events, crawl state, reports."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgextract.session import file_system


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """K1: nulls as blanks, a header per file; `files` only for results known to be small."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


PEOPLE = ["role", "name", "email", "source", "found_via", "confidence"]


def export_results(people: DataFrame, folder: str, stamp: str) -> dict[str, str]:
    """K2: people and their addresses (each once, sorted), as CSV and as JSON, under names with the time stamp."""
    rows = people.select(*PEOPLE)
    emails = people.select("email").filter("email <> ''").distinct().orderBy("email")
    paths = {f"{kind}_{form}": f"{folder}/{kind}_{stamp}.{form}" for kind in ("people", "emails") for form in ("csv", "json")}
    for kind, df in (("people", rows), ("emails", emails)):
        write_csv(df, paths[f"{kind}_csv"])
        write_json(df, paths[f"{kind}_json"])
    return paths


def report(df: DataFrame, columns: list[str], n: int = 100) -> list[str]:
    """The first n rows of a ranked result as lines; the limit is the feature."""
    return [" · ".join("" if v is None else str(v) for v in r) for r in df.select(*columns).limit(n).collect()]


def append_events(df: DataFrame, path: str, run_id: str) -> None:
    """K3: one directory per run; writing a run again replaces it, so a retry adds no duplicates. Readers see one
    table with the column run_id; append_csv gives text instead."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def append_csv(df: DataFrame, path: str, run_id: str) -> None:
    """K3: the same as text: one folder per run under the path, each file with a header."""
    df.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(f"{path}/run_id={run_id}")


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


STATE = {"visited": "node string, depth int", "frontier": "node string, depth int", "sites": "site string, pages bigint, done boolean"}


def save_state(path: str, **parts: DataFrame) -> None:
    """K7: visited, frontier and sites (any of them), as one more generation beside the last; a reader of the
    last one isn't disturbed, and the marker of a generation is written after its parts."""
    spark = next(iter(parts.values())).sparkSession
    at = (_generation(spark, path) or 0) + 1
    for name, df in parts.items():
        df.write.mode("overwrite").parquet(os.path.join(path, str(at), name))
    fs, marker = file_system(spark, os.path.join(path, str(at), "_DONE"))
    fs.create(marker, True).close()


def _generation(spark: SparkSession, path: str) -> int | None:
    if not exists(spark, path):
        return None
    fs, at = file_system(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(at)]
    whole = [int(n) for n in names if n.isdigit() and exists(spark, f"{path}/{n}/_DONE")]
    return max(whole, default=None)


def load_state(spark: SparkSession, path: str, part: str, schema: str | None = None) -> DataFrame:
    """K8: a part of the last whole generation; empty where nothing was saved. An unreadable folder is an error."""
    schema = schema or STATE[part]
    at = _generation(spark, path)
    if at is None or not exists(spark, f"{path}/{at}/{part}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{at}/{part}")


def reset_state(spark: SparkSession, path: str) -> None:
    """K9: on whatever file system the path is; a missing folder is no error, one that can't be removed is."""
    fs, at = file_system(spark, path)
    if fs.exists(at) and not fs.delete(at, True):
        raise OSError(f"{path} can't be removed")


def encode_state(df: DataFrame) -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("state"))


def decode_state(df: DataFrame, schema: str) -> DataFrame:
    """Rows from JSON texts; what doesn't parse is left out."""
    kind = T.StructType.fromDDL(schema)
    return df.select(F.from_json("state", kind, {"columnNameOfCorruptRecord": "_bad"}).alias("_s")).filter("_s IS NOT NULL").select("_s.*")
