"""Neighbour joins between spans of one document (JN2-JN4). Every join has the document as an
equality key, so none becomes a nested loop over the corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _near(hits: DataFrame, spans: DataFrame, key: str, reach: int, ends: list[str]) -> DataFrame:
    """hits with spans of the same document in the same or a neighbouring stretch of `reach` characters.

    The stretch is part of the join key, so a long document doesn't bring all its hits and spans together.
    """
    h = hits.select(key, "pos").distinct().withColumn("_b", F.floor(F.col("pos") / reach))
    stretches = F.array_distinct(F.flatten(F.array(*[F.array(*[F.floor(F.col(c) / reach) + d for d in (-1, 0, 1)]) for c in ends])))
    s = spans.withColumnRenamed(key, "_k").withColumn("_s", F.explode(stretches))
    return h.join(s, (F.col(key) == F.col("_k")) & (F.col("_b") == F.col("_s"))).drop("_k", "_b", "_s")


def nearest_span(hits: DataFrame, spans: DataFrame, key: str, reach: int) -> DataFrame:
    """JN2: hits (key, pos, ...) with the text of the nearest span (key, start, end, text) within reach, '' if none.

    Distance is to the nearer end; ties go to the earlier span.
    """
    s = spans.select(key, F.col("start").alias("_a"), F.col("end").alias("_e"), F.col("text").alias("_text"))
    d = F.least(F.abs(F.col("_a") - F.col("pos")), F.abs(F.col("_e") - F.col("pos")))
    near = (
        _near(hits, s, key, reach, ["_a", "_e"])
        .withColumn("_d", d)
        .filter(F.col("_d") <= reach)
        .groupBy(key, "pos")
        .agg(F.min_by("_text", F.struct("_d", "_a")).alias("nearest"))
    )
    return hits.join(near, [key, "pos"], "left").withColumn("nearest", F.coalesce("nearest", F.lit("")))


def in_window(hits: DataFrame, spans: DataFrame, key: str, reach: int) -> DataFrame:
    """JN3: hits with every span that begins within reach."""
    s = spans.select(key, F.col("start").alias("span_start"), F.col("text").alias("span_text"))
    near = _near(hits, s, key, reach, ["span_start"]).filter(F.abs(F.col("span_start") - F.col("pos")) <= reach)
    return hits.join(near, [key, "pos"])


def neighbour_line(lines: DataFrame, key: str, reach: int = 5, is_service: Callable[[Column], Column] | None = None) -> DataFrame:
    """JN4: key, role, name from the lines (key, line_no, role, name; '' where a line has none) of a text.

    The role is that of the last role line. The name is the one on the line nearest to the last line
    that has a name within reach, in the order 0, +1, -1, +2, -2, ... A line with a service role
    blanks the role and ends the scan: what follows it decides nothing, though its name can be read.
    """
    service = F.lit(False) if is_service is None else is_service(F.col("role"))
    ends = lines.filter((F.col("role") != "") & service).groupBy(key).agg(F.min("line_no").alias("_end"))
    read = lines.join(ends, key, "left").filter("_end IS NULL OR line_no < _end")
    role = lines.join(ends, key, "left").groupBy(key).agg(
        F.max_by("role", F.when((F.col("role") != "") & F.col("_end").isNull(), F.col("line_no"))).alias("role")
    )
    n = lines.filter("name <> ''").select(F.col(key).alias("_k"), F.col("line_no").alias("_n"), F.col("name").alias("_name"))
    n = n.withColumn("_at", F.explode(F.sequence(F.col("_n") - reach, F.col("_n") + reach)))
    delta = F.col("_n") - F.col("line_no")
    rank = F.abs(delta) * 2 - (delta > 0).cast("int")
    named = read.join(n, (F.col(key) == F.col("_k")) & (F.col("line_no") == F.col("_at"))).groupBy(key, "line_no").agg(F.min_by("_name", rank).alias("name"))
    name = named.groupBy(key).agg(F.max_by("name", "line_no").alias("name"))
    return role.join(name, key, "left").select(key, F.coalesce("role", F.lit("")).alias("role"), F.coalesce("name", F.lit("")).alias("name"))


def keep_first(df: DataFrame, keys: list, order: list) -> DataFrame:
    """The first row per key. A map-side minimum of the whole row, so a hot key is
    reduced before the shuffle; `order` must be total for a defined result."""
    cols = df.columns
    by = [k if not isinstance(k, str) else F.col(k) for k in keys]
    named = [b.alias(f"_k{i}") for i, b in enumerate(by)]
    row = F.struct(*[F.col(c) for c in cols])
    return df.groupBy(*named).agg(F.min_by(row, F.struct(*[F.col(o) for o in order])).alias("_r")).select("_r.*")


def cap_per_key(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The first n rows per key. Rows are capped per (key, salt) first, so a key with
    a third of all rows is cut down in parallel before its final ranking."""
    salt = F.pmod(F.xxhash64(*[F.col(o) for o in order]), F.lit(64))
    first = Window.partitionBy(key, "_salt").orderBy(*order)
    final = Window.partitionBy(key).orderBy(*order)
    x = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= n)
    return x.withColumn("_r", F.row_number().over(final)).filter(F.col("_r") <= n).drop("_r", "_salt")
