"""A named folder of tables that outlives the application and grows by commits.

A table is cut into numbered parts. A commit writes the parts it touches into a folder of its own
and then, by one atomic rename, a manifest that names the versions each part
consists of: readers see a commit whole or not at all, and two writers can't both make the
same version. Parts a commit doesn't name stay as they are, so what a batch reads and writes
depends on the parts it touches, not on the history.

Defined results
* a table or part never written reads as an empty DataFrame of the given schema;
* a commit that fails before its manifest leaves the store as it was, beside files no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgextract.session import file_system


class Store:
    """open() gives the last commit; read() and write() work against it, commit() makes the next."""

    def __init__(self, spark: SparkSession, path: str, manifest: dict):
        self.spark, self.path = spark, path.rstrip("/")
        self.version: int = manifest["version"]
        self.settings: dict = manifest["settings"]
        self.parts: dict[str, dict[int, list[str]]] = {t: {int(k): v for k, v in x.items()} for t, x in manifest["parts"].items()}
        self._folder = f"{self.version + 1}-{uuid.uuid4().hex[:8]}"  # no two writers share it
        self._staged: dict[str, dict[int, list[str]]] = {}

    @classmethod
    def open(cls, spark: SparkSession, path: str, settings: dict | None = None) -> Store:
        """The store in a folder; a new one with these settings where there is none. Settings of an existing one stay."""
        path = path.rstrip("/")
        fs, folder = file_system(spark, f"{path}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        versions = sorted(int(n) for n in names if n.isdigit())
        if not versions:
            return cls(spark, path, {"version": 0, "settings": settings or {}, "parts": {}})
        fs, at = file_system(spark, f"{path}/manifests/{versions[-1]}")
        stream = fs.open(at)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return cls(spark, path, json.loads(text))

    def read(self, table: str, schema: T.StructType, parts: list[int] | None = None) -> DataFrame:
        """The table, or only the named parts of it, with what this writer has staged; `schema` is without
        the column `part`, which is added."""
        full = T.StructType([*schema.fields, T.StructField("part", T.IntegerType())])
        known = self.parts.get(table, {}) | self._staged.get(table, {})
        chosen = known if parts is None else [p for p in parts if p in known]
        folders = [f"{self.path}/{table}/version={v}/part={p}" for p in chosen for v in known[p]]
        if not folders:
            return self.spark.createDataFrame([], full)
        on_disk = T.StructType([*schema.fields, T.StructField("version", T.StringType()), T.StructField("part", T.IntegerType())])
        return self.spark.read.option("basePath", f"{self.path}/{table}").schema(on_disk).parquet(*folders).select(*full.names)

    def write(self, table: str, df: DataFrame, replace: bool) -> list[int]:
        """Stages df, which has a column `part`: each of its parts is replaced by these rows or gets them appended."""
        folder = f"{self.path}/{table}/version={self._folder}"
        df.repartition("part").write.mode("overwrite").partitionBy("part").parquet(folder)
        fs, at = file_system(self.spark, folder)
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        touched = [int(n.removeprefix("part=")) for n in names if n.startswith("part=")]
        known = self.parts.get(table, {})
        self._staged.setdefault(table, {}).update({p: ([] if replace else known.get(p, [])) + [self._folder] for p in touched})
        return touched

    def compact(self, table: str, schema: T.StructType) -> None:
        """Stages every part of a table that has grown by appends as one version."""
        grown = [p for p, versions in self.parts.get(table, {}).items() if len(versions) > 1]
        if grown:
            self.write(table, self.read(table, schema, grown), replace=True)

    def commit(self) -> Store:
        """The store with what was staged; fails if another writer made this version first."""
        parts = {t: self.parts.get(t, {}) | self._staged.get(t, {}) for t in {*self.parts, *self._staged}}
        manifest = {"version": self.version + 1, "settings": self.settings, "parts": parts}
        fs, at = file_system(self.spark, f"{self.path}/manifests/{self.version + 1}")
        _, draft = file_system(self.spark, f"{self.path}/manifests/draft-{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(manifest), "utf-8"))
        finally:
            stream.close()
        if fs.exists(at) or not fs.rename(draft, at):
            raise RuntimeError(f"version {self.version + 1} of {self.path} was made by another writer")
        return Store(self.spark, self.path, manifest)


def touched_parts(df: DataFrame, limit: int) -> list[int]:
    """The parts a batch has rows in: at most as many numbers as a table has parts."""
    return [r[0] for r in df.select("part").distinct().limit(limit).collect()]


def part_of(*columns: str, parts: int):
    return F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int").alias("part")
