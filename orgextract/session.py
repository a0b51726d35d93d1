"""Session helpers shared by operators: table loading, shared folder, checkpoints."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir if the cluster names one.

    Only where the setting is absent (tests, a local master) a local folder is chosen.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return str(current.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = os.path.join(tempfile.gettempdir(), "orgextract-shared")
    os.makedirs(own, exist_ok=True)
    return "file://" + own


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one for a query's own store; it goes when the application ends."""
    path = f"{shared_dir(spark)}/orgextract-{label}-{uuid.uuid4().hex}"
    fs, at = file_system(spark, path)
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return path


def file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: compressed, column-pruned lineage cut.

    The files outlive lost executors; they are removed when the application ends, or earlier by discard().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/orgextract-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, at = file_system(spark, path)
    fs.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Removes the files of a stored table that no later step reads."""
    path = getattr(df, "_stored_at", None)
    if path:
        fs, at = file_system(df.sparkSession, path)
        fs.delete(at, True)
