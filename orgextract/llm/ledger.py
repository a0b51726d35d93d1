"""Copies hidden by formatting: an incremental ledger of canonical keys (problem 2).

The ledger is a named store cut into buckets. It holds one row per canonical key: the number
of copies so far and the earliest record. A batch is aggregated by key (map-side partial
counts first, so a key with a third of the rows costs one row per task), the buckets it has
keys in are read and joined with it in full, counts are added, and only these buckets are
written again. Other buckets are neither read nor written, and the ledger outlives the
application: `open_ledger` gives the last commit.

With B buckets and K keys a batch of n keys reads and writes at most min(n, B) * K / B rows;
B is chosen when a ledger is made (`BUCKETS` for a ledger of up to some 10 million keys; a
bucket should stay a file of a few MB), so a small batch costs a small share of the history.

Defined results
* the key is the sorted list of the fields' letters and digits, so letter case, Unicode
  composition, punctuation, null against empty and field order make no difference; a
  record with all fields empty has a key like any other;
* merging is independent of batch order: counts add, the smallest id stays; an empty batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgextract.functions.unicode import letters_digits
from orgextract.session import discard, stored
from orgextract.sources.store import Store, part_of, touched_parts

BUCKETS = 64
TABLE = "ledger"
SCHEMA = T.StructType([T.StructField("_digest", T.BinaryType()), T.StructField("copies", T.LongType()), T.StructField("first_id", T.LongType())])


def canonical_key(fields: list[str]):
    return F.array_join(F.array_sort(F.array(*[letters_digits(F.col(f)) for f in fields])), "\u0001")


def keyed(df: DataFrame, id_col: str, fields: list[str], carry: list[str] = ()) -> DataFrame:
    """_id, carried columns and a 128-bit digest of the canonical key; the key itself isn't shuffled."""
    x = df.select(F.col(id_col).cast("bigint").alias("_id"), *carry, canonical_key(fields).alias("_key"))
    return x.select("_id", *carry, F.unhex(F.md5("_key")).alias("_digest"))


def open_ledger(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Store:
    """The ledger kept in a folder, or a new one cut into `buckets`."""
    return Store.open(spark, path, {"buckets": buckets})


def rows_of(ledger: Store, buckets: list[int] | None = None) -> DataFrame:
    """_digest, copies, first_id of the whole ledger or of some buckets."""
    return ledger.read(TABLE, SCHEMA, buckets).select(*SCHEMA.names)


def aggregate_batch(batch: DataFrame, buckets: int) -> DataFrame:
    counted = batch.groupBy("_digest").agg(F.count("*").alias("copies"), F.min("_id").alias("first_id"))
    return counted.select(part_of("_digest", parts=buckets), *SCHEMA.names)


def merge(ledger: Store, batch: DataFrame) -> Store:
    """The ledger after one more batch of keyed rows, committed."""
    buckets = ledger.settings["buckets"]
    new = aggregate_batch(batch, buckets)
    if ledger.version == 0:
        ledger.write(TABLE, new, replace=True)
        return ledger.commit()
    new = stored(new, "batch")
    held = ledger.read(TABLE, SCHEMA, touched_parts(new, buckets))
    add = new.select("part", "_digest", F.col("copies").alias("_n"), F.col("first_id").alias("_f"))
    out = held.join(add, ["part", "_digest"], "full").select(
        "part",
        "_digest",
        (F.coalesce("copies", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("copies"),
        F.least("first_id", "_f").alias("first_id"),
    )
    ledger.write(TABLE, out, replace=True)
    discard(new)
    return ledger.commit()


#: Keys that hold more than 1/HOT_SHARE of all rows number fewer than HOT_SHARE: a proven bound for broadcasting.
HOT_SHARE = 2000


def copies(rows: DataFrame, ledger: Store) -> DataFrame:
    """first_id, _id for every row that isn't the first of its key.

    Keys above the hot share are fewer than HOT_SHARE and are broadcast; the rest meet in
    a shuffle join in which no key exceeds that share.
    """
    held = rows_of(ledger)
    repeated = held.filter("copies > 1")
    total = held.agg(F.sum("copies")).first()[0] or 0
    limit = max(total // HOT_SHARE, 1000)
    hot = F.broadcast(repeated.filter(F.col("copies") > limit))
    cold = repeated.filter(F.col("copies") <= limit)
    pairs = [
        rows.join(side, "_digest").filter("_id > first_id").select("first_id", "_id") for side in (hot, cold)
    ]
    return pairs[0].unionByName(pairs[1])
