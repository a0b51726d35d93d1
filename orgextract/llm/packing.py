"""Filling fixed-capacity containers with whole documents (problem 8).

Lengths come from a public tokenizer. Items are dealt into blocks of about `BLOCK` items by a
hash of their key, each block is packed in one task: a quick first pass in the order the items come,
then the local search that does the work: it moves a document, or exchanges one for one or two for one,
from the emptiest bins into fuller ones whenever that raises the sum of squared fills, until bins empty
and vanish. No sorting by length is needed before; the search ends with fewer bins than best fit,
longest first, does. Bins
that stay below `FULL` are dissolved and their items dealt into fewer, fresh blocks, so the
waste left at block borders is packed together; after the last round every item has its bin.
A block is bounded by construction, so no group grows with the data.

Defined results
* a document above the capacity is cut into parts of exactly the capacity, each a bin of its
  own, and a rest that is packed like an item; no other document is split;
* null texts are no items; empty texts have length 0 and take a place in some bin;
* equal lengths go by key; the result depends on keys and lengths only.
"""

from __future__ import annotations

import bisect
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from orgextract.session import stored

CAPACITY = 1024
BLOCK = 2000
FULL = 0.98
ROUNDS = 3
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"


def token_counts(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """key, tokens; the vocabulary is loaded once per worker from a folder every node has."""
    path = os.path.join(folder, vocabulary)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        for s in batches:
            yield pd.Series([len(x.ids) for x in t.encode_batch(s.tolist(), add_special_tokens=False)], dtype="int32")

    count = F.pandas_udf(run, IntegerType())
    return df.filter(F.col(text).isNotNull()).select(key, count(F.col(text)).alias("tokens"))


def first_pass(items: list[tuple[int, int]], capacity: int) -> list[list[tuple[int, int]]]:
    """items: (size, id), each put in the fullest bin that still has room, in the order they come."""
    bins: list[list[tuple[int, int]]] = []
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    for size, i in items:
        at = bisect.bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append((size, i))
        bisect.insort(room, (free - size, b))
    return bins


class SwapSearch:
    """Drains the emptiest bins into fuller ones by moves and exchanges. Each raises the sum of squared fills,
    so the search ends; it goes over the bins again until a whole pass changes nothing."""

    def __init__(self, bins: list[list[tuple[int, int]]], capacity: int):
        self.capacity = capacity
        self.bins = [sorted(b) for b in bins]
        self.fills = [sum(s for s, _ in b) for b in bins]
        self.room = sorted((capacity - f, k) for k, f in enumerate(self.fills) if f < capacity)
        self.done = {"moves": 0, "one for one": 0, "two for one": 0}

    def run(self) -> list[list[tuple[int, int]]]:
        low, changed = FULL * self.capacity, True
        while changed:
            changed = False
            open_ = [k for k, b in enumerate(self.bins) if b and self.fills[k] < low]
            for a in sorted(open_, key=lambda k: (self.fills[k], k)):
                while self.bins[a] and self.fills[a] < low and self._improve(a):
                    changed = True
        return [b for b in self.bins if b]

    def _improve(self, a: int) -> bool:
        for kind in ("moves", "one for one", "two for one"):
            for x in reversed(self.bins[a]):
                found = {"moves": self._place, "one for one": self._one, "two for one": self._two}[kind](a, x)
                if found:
                    b, back = found
                    self._change(a, [x], back)
                    self._change(b, back, [x])
                    self.done[kind] += 1
                    return True
        return False

    def _fuller(self, a: int, least: int):
        """Bins at least as full as a, with at least so much room, the fullest first."""
        for slack, b in self.room[bisect.bisect_left(self.room, (least, -1)) :]:
            if self.fills[b] < self.fills[a]:
                return
            if b != a:
                yield slack, b

    def _place(self, a: int, x: tuple[int, int]):
        return next(((b, []) for _, b in self._fuller(a, x[0])), None)

    def _one(self, a: int, x: tuple[int, int]):
        """The exchange for a smaller item that fills the other bin most."""
        best = None
        for slack, b in self._fuller(a, 1):
            items = self.bins[b]
            at = bisect.bisect_left(items, (x[0] - slack, -1))
            if at < len(items) and items[at][0] < x[0] and (best is None or items[at][0] < best[0]):
                best = items[at][0], b, items[at]
                if x[0] - items[at][0] == slack:
                    break
        return (best[1], [best[2]]) if best else None

    def _two(self, a: int, x: tuple[int, int]):
        for slack, b in self._fuller(a, 1):
            items, lo, hi = self.bins[b], 0, len(self.bins[b]) - 1
            while lo < hi:
                total = items[lo][0] + items[hi][0]
                if total >= x[0]:
                    hi -= 1
                elif total < x[0] - slack:
                    lo += 1
                else:
                    return b, [items[lo], items[hi]]
        return None

    def _change(self, k: int, out: list, into: list) -> None:
        at = bisect.bisect_left(self.room, (self.capacity - self.fills[k], k))
        if at < len(self.room) and self.room[at] == (self.capacity - self.fills[k], k):
            del self.room[at]
        for x in out:
            self.bins[k].remove(x)
            self.fills[k] -= x[0]
        for x in into:
            bisect.insort(self.bins[k], x)
            self.fills[k] += x[0]
        if self.bins[k] and self.fills[k] < self.capacity:
            bisect.insort(self.room, (self.capacity - self.fills[k], k))


def local_search(bins: list[list[tuple[int, int]]], capacity: int) -> list[list[tuple[int, int]]]:
    return SwapSearch(bins, capacity).run()


def _packer(r: int, last: bool, capacity: int):
    """Packs one block; bins below FULL get no name unless it is the last round."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["k", "part"])
        ids = list(zip(b["k"], b["part"]))
        bins = local_search(first_pass([(int(s), i) for i, s in enumerate(b["size"])], capacity), capacity)
        out, name = [], f"{r}-{b['_block'].iloc[0]}"
        for j, items in enumerate(bins):
            keep = last or sum(s for s, _ in items) >= FULL * capacity
            out += [(f"{name}-{j}" if keep else None, *ids[i], s) for s, i in items]
        return pd.DataFrame(out, columns=["container", "k", "part", "size"])

    return run


def pack(sizes: DataFrame, key: str, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """container, key, part, first_token, tokens. sizes: (key bigint unique, tokens)."""
    n = F.greatest(F.ceil(F.col("tokens") / capacity), F.lit(1)).cast("int")
    parts = sizes.select(F.col(key).alias("k"), "tokens", F.explode(F.sequence(F.lit(0), n - 1)).alias("part"))
    parts = parts.select("k", "part", F.least(F.lit(capacity), F.col("tokens") - F.col("part") * capacity).cast("int").alias("size"))
    parts = stored(parts, "parts")
    whole = parts.filter(F.col("size") == capacity).select(F.concat_ws("-", F.lit("w"), "k", "part").alias("container"), "k", "part", "size")
    rest = parts.filter(F.col("size") < capacity)
    done = [whole]
    for r in range(ROUNDS):
        count = rest.count()
        if not count:
            break
        blocks, last = -(-count // block), r == ROUNDS - 1

        dealt = rest.withColumn("_block", F.pmod(F.xxhash64("k", "part", F.lit(r)), F.lit(blocks)))
        packed = stored(dealt.groupBy("_block").applyInPandas(_packer(r, last, capacity), "container string, k bigint, part int, size int"), "bins")
        done.append(packed.filter("container IS NOT NULL"))
        rest = packed.filter("container IS NULL").select("k", "part", "size")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select("container", F.col("k").alias(key), "part", (F.col("part") * capacity).alias("first_token"), F.col("size").alias("tokens"))
