"""Organisation lists (S1-S6): header-agnostic CSV, URL columns found by name or content."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgextract.functions import urls as u
from orgextract.operators.nearest import keep_first

URL_HEADERS = ["domain", "url", "website", "web", "homepage"]
NAME_HEADERS = ["credit_union", "cuname", "name", "creditunion"]
URL_LIKE = r"(?i)^\s*[\"']*(?:https?://)?[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}(?:[:/?#].*)?\s*$"


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Every column a string, blanks as '', a byte order mark dropped from the first header."""
    df = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def read_csv_any(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """UTF-8; if it has replacement characters, Latin-1."""
    df = read_csv(spark, path, sep)
    broken = reduce(lambda a, b: a | b, [F.contains(F.col(f"`{c}`"), F.lit("�")) for c in df.columns])
    return read_csv(spark, path, sep, "ISO-8859-1") if not df.filter(broken).isEmpty() else df


def role_columns(columns: list[str]) -> tuple[str | None, str | None]:
    """(URL column, name column), the first in column order whose header says so."""
    norm = {c: "".join(c.lower().split()) for c in columns}
    pick = lambda names: next((c for c in columns if norm[c] in names), None)
    return pick(URL_HEADERS), pick(NAME_HEADERS)


def is_url_like(c: Column) -> Column:
    return F.coalesce(c.rlike(URL_LIKE), F.lit(False))


def column_scores(df: DataFrame) -> DataFrame:
    """S3, A1: column_name, hits; one aggregate row turned into one row per column."""
    one = df.agg(*[F.count_if(is_url_like(F.col(f"`{c}`"))).alias(c) for c in df.columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("hits")) for c in df.columns])))


def url_column(df: DataFrame) -> str | None:
    """S3: the column with most URL-like cells, ties to the first; a single column always."""
    scores = {r["column_name"]: r["hits"] for r in column_scores(df).collect()}  # one row per column
    best = max(df.columns, key=lambda c: (scores[c], -df.columns.index(c)))
    return best if scores[best] else (df.columns[0] if len(df.columns) == 1 else None)


def first_url(columns: list[str]) -> Column:
    """The first URL-like cell of a row, null if none."""
    return F.coalesce(*[F.when(is_url_like(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in columns])


def seeds(df: DataFrame) -> DataFrame:
    """name, url of an organisation list: S2 else S3, S4 for blank cells, A11 by host; nameless rows are named by host."""
    url, name = role_columns(df.columns)
    url = url or url_column(df)
    order = [url] if url else []
    raw = first_url(order + [c for c in df.columns if c != url])
    label = F.nullif(u.strip(F.col(f"`{name}`")), F.lit("")) if name else F.lit(None).cast("string")
    x = df.withColumn("_raw", raw).filter("_raw IS NOT NULL").withColumn("_o", F.monotonically_increasing_id())
    # a generator, so that the filter isn't pushed down to where the URL would be computed again
    x = x.select(label.alias("name"), F.explode(F.array(u.normalize_url(F.col("_raw")))).alias("url"), "_o")
    x = x.filter("url <> ''").withColumn("name", F.coalesce("name", u.name_from_url(F.col("url")))).withColumn("_h", u.host_root(F.col("url")))
    return keep_first(x, ["_h"], ["_o"]).select("name", "url")


def positional(df: DataFrame) -> DataFrame:
    """A column named url with the first column as name (blank if it is the only one); else columns one and two."""
    cols = df.columns
    at = next((c for c in cols if c.strip().lower() == "url"), None)
    if at:
        return df.select((F.lit("") if len(cols) == 1 else F.col(f"`{cols[0]}`")).alias("name"), F.col(f"`{at}`").alias("url"))
    return df.select(F.col(f"`{cols[0]}`").alias("name"), F.col(f"`{cols[1]}`").alias("url"))
