"""Entity spans (T17) behind an interface. A model-based tagger can be plugged in; the default
finds capitalised runs and organisation words by pattern, in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgextract import profiles as p
from orgextract.functions.text import spans

Tagger = Callable[[DataFrame, str, str], DataFrame]
ORG = r"\b(?:[A-Z][\w&'-]+ )+(?:Credit Union|FCU|CU|Bank|Inc\.?|LLC|Foundation|Association|Council)\b"


def pattern_tagger(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, label, start, end, text."""
    org = spans(df, [key], text, ORG).withColumn("label", F.lit("ORG"))
    person = spans(df, [key], text, p.NAME_A).withColumn("label", F.lit("PERSON"))
    return person.unionByName(org).select(key, "label", "start", "end", F.col("match").alias("text"))


def entity_spans(df: DataFrame, key: str, text: str, tagger: Tagger = pattern_tagger) -> DataFrame:
    return tagger(df, key, text)
