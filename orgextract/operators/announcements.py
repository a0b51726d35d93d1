"""Feed announcements: classification, new against the previous snapshot (X14, JN1, I5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orgextract.functions.entities import Tagger, entity_spans, pattern_tagger
from orgextract.functions.text import is_announcement, joined_or_na
from orgextract.operators.skew import short_list


def classify(entries: DataFrame) -> DataFrame:
    """Entries (title, description, link) whose text holds a key phrase."""
    return entries.filter(is_announcement(F.concat_ws(" ", "title", "description", "link")))


def with_entities(entries: DataFrame, key: str, tagger: Tagger = pattern_tagger) -> DataFrame:
    """Entries with persons and organizations: arrays of what stands in title, description and link, in order."""
    text = entries.select(key, F.concat_ws(" ", "title", "description", "link").alias("_txt"))
    found = entity_spans(text, key, "_txt", tagger)
    listed = lambda label: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("label") == label, F.struct("start", "text")))), lambda x: x["text"]
    )  # one entry's entities
    found = found.groupBy(key).agg(listed("PERSON").alias("persons"), listed("ORG").alias("organizations"))
    none = F.array().cast("array<string>")
    return entries.join(found, key, "left").withColumn("persons", F.coalesce("persons", none)).withColumn("organizations", F.coalesce("organizations", none))


def rows(entries: DataFrame, *keys: str) -> DataFrame:
    """keys, Title, Link, Persons, Organizations; persons and organisations are arrays on input."""
    return entries.select(
        *keys, F.col("title").alias("Title"), F.col("link").alias("Link"), joined_or_na(F.col("persons")).alias("Persons"), joined_or_na(F.col("organizations")).alias("Organizations")
    )


def new_per_run(rows: DataFrame, stream: list[str], order: str) -> DataFrame:
    """JN1, I5 over all runs of the streams at once: rows whose (Title, Link) the run before it in its stream didn't hold.

    A row with a null in either never equals, so it is always new; every row of a first run is new.
    """
    runs = rows.select(*stream, order).distinct()
    after = short_list(runs.withColumn("_next", F.lead(order).over(Window.partitionBy(*stream).orderBy(order))).filter("_next IS NOT NULL"))
    held = rows.join(after, [*stream, order]).select(*stream, F.col("_next").alias(order), "Title", "Link").distinct()
    return rows.join(held, [*stream, order, "Title", "Link"], "left_anti")


def new_rows(current: DataFrame, previous: DataFrame) -> DataFrame:
    """JN1: rows of current without an equal (Title, Link) in previous; a null never equals, so it is always new."""
    return current.join(previous.select("Title", "Link").distinct(), ["Title", "Link"], "left_anti")
