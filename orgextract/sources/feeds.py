"""RSS and Atom files (S7) and the announcement snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgextract.session import file_system
from orgextract.sources.store import Store

ENTRY = T.StructType([T.StructField(c, T.StringType()) for c in ("title", "description", "link")])
SNAPSHOT = T.StructType([T.StructField(c, T.StringType()) for c in ("Title", "Link", "Persons", "Organizations")])


ATOM = T.StructType(
    [
        T.StructField("title", T.StringType()), T.StructField("summary", T.StringType()), T.StructField("content", T.StringType()),
        T.StructField("link", T.ArrayType(T.StructType([T.StructField("_href", T.StringType()), T.StructField("_rel", T.StringType()), T.StructField("_VALUE", T.StringType())]))),
    ]
)


def _xml(spark: SparkSession, paths: list[str], row_tag: str, schema: T.StructType) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", "DROPMALFORMED").schema(schema).load(paths)


def read_feed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Title, description, link per RSS item or Atom entry; missing parts are ''.

    An Atom link is the attribute of its first link element that isn't one of another kind. Broken
    files give no rows and missing ones are left out, so one feed's failure leaves the others whole.
    """
    paths = [p for p in ([path] if isinstance(path, str) else path) if any_file(spark, p)]
    if not paths:
        return spark.createDataFrame([], ENTRY)
    rss = _xml(spark, paths, "item", ENTRY)
    own = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.get(own, F.lit(0))["_href"], F.get("link", F.lit(0))["_href"])
    atom = _xml(spark, paths, "entry", ATOM).select("title", F.coalesce("summary", "content").alias("description"), link.alias("link"))
    return rss.unionByName(atom).select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in ENTRY.names])


def any_file(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return bool(fs.globStatus(at))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The last snapshot; an empty table of the same schema where nothing was written yet."""
    return Store.open(spark, path).read("snapshot", SNAPSHOT).drop("part")


def replace_snapshot(df: DataFrame, path: str) -> None:
    """K4: the new snapshot is written beside the old one and takes its place in one commit; a crash leaves the old one."""
    parts = F.pmod(F.xxhash64("Title", "Link"), F.lit(SNAPSHOT_PARTS)).cast("int").alias("part")
    store = Store.open(df.sparkSession, path)
    store.parts.pop("snapshot", None)
    store.write("snapshot", df.select(parts, *SNAPSHOT.names), replace=True)
    store.commit()


SNAPSHOT_PARTS = 16
