"""Test items inside training text: rare n-gram seeds, then Smith-Waterman alignment (problem 9).

A window of `span` words with at most `slips` replaced words holds an exact run of at least
n = (span - slips) / (slips + 1) words, so the n-grams of the items (6 words for 12 and one slip)
are complete seeds. Their document frequency is counted over all documents. A rare one ties a
document to an item by itself. A frequent one (a signature, a stock phrase) is lengthened until
it is rare: the word before or after it must agree too, or, past one other word, n - 1 more. A window
that holds the frequent seed always has one of these, so none is lost.

Only documents with a seed travel on, each once, with the diagonals (word offset between
document and item) on which seeds lie. A banded Smith-Waterman alignment along these accepts a
pair by its score, gaps allowed: `find_copies` gives these, edited copies with inserted, dropped,
split or joined words included, as long as one run of a seed's length is left whole. `find_leaks`
narrows them by an exact check of the windows on the accepted bands. It loses nothing: a window of
`span` words with `slips` replaced scores 2 * (span - slips) - slips on its own diagonal, which is
the least score.

Defined results
* null or empty texts have no words; texts shorter than the span never leak nor are leaked;
* case, markup, entities, quote marks, punctuation and line breaks don't count;
* items that share words each give a row; exact copies of a document each give their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgextract.operators.skew import join_counted
from orgextract.session import stored

#: Seed rows of the item side that may be broadcast.
BROADCAST_SEEDS = 2_000_000
SPAN, SLIPS = 12, 1
#: Diagonals an alignment may leave its seeds by, to either side.
BAND = 4

_BLOCK = r"(?i)</?(?:p|br|blockquote|div|ul|ol|li|h[1-6]|hr|table|tr|td|th|pre)\b[^<>]*>|\[/?(?:quote|list|code)\b[^\[\]]*\]|&(?:#\d{1,7}|#x[0-9a-f]{1,6}|[a-z][a-z0-9]{1,30});"
_INLINE = r"(?i)</?[a-z][^<>]*>|\[/?(?:b|i|u|s|url|img|color|size|font|center)\b[^\[\]]*\]"


def words(text: Column) -> Column:
    """Lower-cased words in order: runs of letters and digits, apostrophes and hyphens within them dropped.

    Other punctuation parts words, so two sentences without a space between stay two words.
    """
    t = F.coalesce(text, F.lit(""))
    marked = F.contains(t, F.lit("<")) | F.contains(t, F.lit("[")) | F.contains(t, F.lit("&"))
    t = F.when(marked, F.regexp_replace(F.regexp_replace(t, _BLOCK, " "), _INLINE, "")).otherwise(t)
    t = F.regexp_replace(F.lower(t), r"(?<=[\p{L}\p{M}\p{N}])['’‐‑-](?=[\p{L}\p{N}])", "")
    return F.filter(F.split(F.regexp_replace(t, r"[^\p{L}\p{M}\p{N}]+", " "), " "), lambda w: w != "")


def seeds(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """key, pos, seed: the hash of every run of n words, each word hashed once."""
    w = df.select(key, F.transform(words(F.col(text)), lambda x: F.xxhash64(x)).alias("_w")).filter(F.size("_w") >= n)
    runs = F.transform(F.sequence(F.lit(1), F.size("_w") - (n - 1)), lambda i: F.xxhash64(F.slice("_w", i, n)))
    return w.select(key, F.posexplode(runs).alias("pos", "seed"))


def alignment(doc: list[int], item: list[int], diagonal: int, band: int) -> int:
    """Smith-Waterman score of words (match 2, other word -1, gap -2) within `band` of a diagonal.

    A row holds the cells of one item word; a cell's place in it is its distance from the band's
    lower edge, so the cell above to the left is the one of the same place in the row before.
    """
    n, width, best = len(doc), 2 * band + 1, 0
    prev = [0] * (width + 1)
    for k, w in enumerate(item):
        base, left = diagonal + k - band, 0
        cur = [0] * (width + 1)
        for c in range(max(0, -base), min(width, n - base)):
            v = prev[c] + (2 if doc[base + c] == w else -1)
            up = prev[c + 1] - 2
            if up > v:
                v = up
            left -= 2
            if left > v:
                v = left
            if v < 0:
                v = 0
            cur[c] = left = v
            if v > best:
                best = v
        prev = cur
    return best


def longest_window(doc: np.ndarray, item: np.ndarray, diagonal: int, slips: int) -> int:
    """Words of the longest run on a diagonal with at most `slips` differing words."""
    lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
    if hi <= lo:
        return 0
    same = doc[lo + diagonal : hi + diagonal] == item[lo:hi]
    wrong = np.concatenate([[-1], np.flatnonzero(~same), [len(same)]])
    if len(wrong) <= slips + 2:
        return int(len(same))
    return int((wrong[slips + 1 :] - wrong[: -(slips + 1)] - 1).max())


def bands(diagonals: np.ndarray, band: int = BAND) -> list[tuple[int, int, list[int]]]:
    """(middle, reach, diagonals) of the bands around seed diagonals; overlapping bands are one."""
    groups: list[list[int]] = []
    for g in sorted(int(x) for x in diagonals):
        if groups and g - groups[-1][-1] <= 2 * band:
            groups[-1].append(g)
        else:
            groups.append([g])
    return [((g[0] + g[-1]) // 2, band + (g[-1] - g[0] + 1) // 2, g) for g in groups]


#: A seed is frequent in more documents than this share of all (or than FREQUENT_LEAST, if that is more).
FREQUENT_SHARE, FREQUENT_LEAST = 1 / 1000, 100


def _lengthened(dw: Column, iw: Column, pos: Column, ipos: Column, n: int) -> Column:
    """Whether a shared n-gram (1-based places) goes on by a word on either side, or by n - 1 words past one other."""
    same = lambda d: F.try_element_at(dw, pos + d) == F.try_element_at(iw, ipos + d)
    inside = lambda lo, hi: (pos + lo >= 1) & (ipos + lo >= 1) & (pos + hi <= F.size(dw)) & (ipos + hi <= F.size(iw))
    run = lambda lo: F.slice(dw, pos + lo, n - 1) == F.slice(iw, ipos + lo, n - 1)
    tests = ((inside(-1, 0), same(-1)), (inside(0, n), same(n)), (inside(-n, 0), run(-n)), (inside(0, 2 * n - 1), run(n + 1)))
    hit = F.lit(False)
    for possible, agrees in tests:
        hit = hit | F.coalesce(F.when(possible, agrees), F.lit(False))
    return hit


def find_copies(
    docs: DataFrame, doc_id: str, items: DataFrame, item_id: str, text: str = "text", span: int = SPAN, slips: int = SLIPS, frequent: int | None = None
) -> DataFrame:
    """doc_id, item_id, longest, score for each document and item whose alignment scores as much as a window does.

    longest: the words of the longest run without a gap and with at most `slips` other words.
    frequent: documents a seed may stand in and count as rare; by default a share of all documents.
    """
    n, least = span // (slips + 1), 2 * (span - slips) - slips
    d = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("_text"))
    i = items.select(F.col(item_id).alias("item"), F.col(text).alias("_text"))
    item_seeds = seeds(i, "item", "_text", n).select("item", F.col("pos").alias("ipos"), "seed")
    if item_seeds.count() <= BROADCAST_SEEDS:
        item_seeds = F.broadcast(item_seeds)
    met = stored(seeds(d, "doc", "_text", n).join(item_seeds, "seed").select("seed", "doc", "item", "pos", "ipos"), "seeds")
    if frequent is None:
        frequent = max(int(docs.count() * FREQUENT_SHARE), FREQUENT_LEAST)
    often = met.groupBy("seed", "doc").agg(F.lit(1).alias("_one")).groupBy("seed").agg(F.count("*").alias("_df")).filter(F.col("_df") > frequent)
    met = met.join(F.broadcast(often), "seed", "left")  # distinct n-grams of the items at most, as counted above
    rare = F.col("_df").isNull()
    hits = met.groupBy("doc", "item").agg(
        F.collect_set(F.col("pos") - F.col("ipos")).alias("diagonals"),  # at most the words of one document
        F.max(rare).alias("rare"),
        F.collect_set(F.when(~rare, F.struct("pos", "ipos"))).alias("places"),
    )
    # a document's words are made once, however many items it shares seeds with
    hash_words = lambda c: F.transform(words(c), lambda w: F.xxhash64(w))
    by_doc = hits.groupBy("doc").agg(F.collect_list(F.struct("item", "diagonals", "rare", "places")).alias("_h"))
    found = by_doc.join(d, "doc").select("doc", hash_words(F.col("_text")).alias("dw"), F.explode("_h").alias("_h")).select("doc", "dw", "_h.*")
    share = hits.groupBy("item").agg(F.count("*").alias("_n"))
    texts = i.join(share, "item").select("item", hash_words(F.col("_text")).alias("iw"), "_n")
    candidates = join_counted(found, texts, "item", "_n")
    longer = F.exists("places", lambda x: _lengthened(F.col("dw"), F.col("iw"), x["pos"], x["ipos"], n))
    candidates = candidates.filter(F.col("rare") | longer).select("doc", "item", "diagonals", "dw", "iw")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, item, diagonals, dw, iw in b.itertuples(index=False):
                scored = [(alignment(dw.tolist(), iw.tolist(), middle, reach), on) for middle, reach, on in bands(diagonals)]
                accepted = [g for points, on in scored if points >= least for g in on]
                if accepted:
                    rows.append((doc, item, max(longest_window(dw, iw, g, slips) for g in accepted), max(scored)[0]))
            yield pd.DataFrame(rows, columns=["doc", "item", "longest", "score"])

    out = candidates.mapInPandas(score, "doc bigint, item bigint, longest int, score int")
    return out.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "longest", "score")


def find_leaks(
    docs: DataFrame, doc_id: str, items: DataFrame, item_id: str, text: str = "text", span: int = SPAN, slips: int = SLIPS, frequent: int | None = None
) -> DataFrame:
    """The copies in which a window of `span` words stands with at most `slips` of them replaced."""
    return find_copies(docs, doc_id, items, item_id, text, span, slips, frequent).filter(F.col("longest") >= span)
