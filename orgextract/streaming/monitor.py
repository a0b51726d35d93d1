"""Streaming variants: new announcements and addresses from a folder of files (I5), a budget per host (I4)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orgextract.functions import emails as e
from orgextract.functions.text import is_announcement


def announcements(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """Announcement rows as they arrive; needs Title, Link and the event time fetched_at."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return stream.filter(is_announcement(F.concat_ws(" ", "Title", "Link")))


def new_announcements(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """Each (Title, Link) once within the watermark; state older than `late` is dropped."""
    return stream.withWatermark("fetched_at", late).dropDuplicatesWithinWatermark(["Title", "Link"])


def address_counts(stream: DataFrame, text: str, ts: str, late: str = "1 hour", every: str = "1 day") -> DataFrame:
    """Addresses per window, append mode: a window is final once the watermark passes it."""
    x = stream.withWatermark(ts, late).select(ts, F.explode(e.find_emails(F.col(text))).alias("email"))
    return x.groupBy(F.window(ts, every), F.lower("email").alias("email")).agg(F.count("*").alias("hits"))


BUDGET_OUT = "host string, url string, ts timestamp, event string"


def watched(visits: DataFrame, seconds: int = 300, late: str = "1 minute") -> DataFrame:
    """I4 as a stream of visits (host, url, ts): event `visit` within the host's budget, `skipped` beyond it, and one
    `budget exceeded` per host that comes from a timer on event time: once the watermark passes the host's first
    visit by the budget, whether or not the host is heard of again. Hosts are independent of each other.

    A host's state is its first time; visits are handled in the order of their times within a batch.
    """

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        end = state.get[0] if state.exists else None
        if state.hasTimedOut:
            state.update((end, True))
            yield pd.DataFrame([(key[0], None, pd.Timestamp(end, unit="ms"), "budget exceeded")], columns=["host", "url", "ts", "event"])
            return
        told = state.get[1] if state.exists else False
        for b in batches:
            b = b.sort_values("ts")
            if end is None:
                end = int(b["ts"].iloc[0].timestamp() * 1000) + seconds * 1000
            over = b["ts"] > pd.Timestamp(end, unit="ms")
            yield pd.DataFrame({"host": b["host"], "url": b["url"], "ts": b["ts"], "event": over.map({True: "skipped", False: "visit"})})
        state.update((end, told))
        if not told:
            state.setTimeoutTimestamp(max(end, state.getCurrentWatermarkMs() + 1))

    x = visits.filter("host IS NOT NULL AND ts IS NOT NULL").select("host", "url", "ts").withWatermark("ts", late)
    return x.groupBy("host").applyInPandasWithState(watch, BUDGET_OUT, "end bigint, told boolean", "append", GroupStateTimeout.EventTimeTimeout)


def write_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exactly once into Parquet; ends when what is there has been read."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
