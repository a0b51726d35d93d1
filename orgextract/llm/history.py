"""New batches against all history: bit-difference fingerprints in rotated block tables (problem 4).

A store is a named folder that outlives the application: the pages and headlines accepted so
far, the fingerprints of the headlines once per block table, and the announcement every page or
headline belongs to. All its tables grow by appends. A batch is reduced to its distinct pages
and headlines; the parts of the store their keys fall in are read, new headlines are looked up
by exact block match, candidates are verified by Hamming distance and then by text, and what
is new is appended. History is read by key, never compared with itself or written again.

A fingerprint (headlines.fingerprint) has two halves of three blocks. Each of the nine tables
is keyed by one block of either half. Headlines that differ in at most two bits in each half
agree in a block of either, so every such pair meets; they are the candidates, no others.
One wrong, missing, added or swapped letter anywhere in the own words stays within these bits.

Text check: two headlines say the same if they state the same position, and a person and an
organisation alike up to slips. A headline whose wording isn't understood names nobody.

Defined results
* null or blank addresses and headlines that name nobody link nothing by themselves;
* rows with neither are announcements of their own; exact repeats are found by their key;
* links carry over from row to row; the first row is the least id; an empty batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgextract.llm import headlines
from orgextract.llm.components import components
from orgextract.llm.editmetric import within
from orgextract.llm.reference_match import Matcher
from orgextract.operators.skew import join_counted, join_split
from orgextract.session import discard, stored
from orgextract.sources.store import Store, part_of, touched_parts

PARTS = 16
#: Differing bits per half within which every pair is found: one less than a half has blocks.
MAX_BITS = 2
_TRACKING = r"(?i)(?<=[?&])(?:utm_[a-z]+|fbclid|gclid|mc_[a-z]+|ref|source|src|campaign|share|amp)=[^&]*(?:&|$)"

_kind = lambda **kw: T.StructType([T.StructField(n, t()) for n, t in kw.items()])
PAGES = _kind(page=T.StringType, rep=T.LongType)
TEXTS = _kind(digest=T.BinaryType, rep=T.LongType)
TITLES = _kind(rep=T.LongType, title=T.StringType)
NAMED = _kind(rep=T.LongType)
BLOCKS = _kind(key=T.IntegerType, fp=T.LongType, rep=T.LongType)
PARENTS = _kind(node=T.LongType, parent=T.LongType)


def page_key(link: Column) -> Column:
    """Host without www., path and identifying parameters; null where there is no page."""
    t = F.regexp_replace(F.trim(F.regexp_replace(link, r"[\s\u200B\uFEFF]+", "")), r"#.*$", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//", ""), r"(?i)^(?:www|m|amp)\.", "")
    t = F.regexp_replace(F.regexp_replace(t, _TRACKING, ""), r"[?&]+$", "")
    host = F.lower(F.regexp_extract(t, r"^([^/?]*)", 1))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_extract(t, r"^[^/?]*(.*)$", 1), r"/+(?=\?|$)", ""), r"^$", "")
    return F.when((host != "") & (rest != ""), F.concat(host, rest))


def read_headlines(df: DataFrame, matcher: Matcher) -> DataFrame:
    """id, page, title, digest of the headline's words and its fingerprint; both null where it has fewer than two own words."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        common = headlines.CommonWords(matcher)
        for s in batches:
            rows = []
            for title in s:
                text, own = headlines.normal(title, common) if title else ("", [])
                rows.append((text, headlines.fingerprint(own)) if len(own) > 1 else (None, None))
            yield pd.DataFrame(rows, columns=["text", "fp"]).astype({"fp": "Int64"})

    read = F.pandas_udf(run, "text string, fp bigint")
    x = df.select("id", "page", "title", read(F.col("title")).alias("_h"))
    return x.select("id", "page", "title", F.unhex(F.md5("_h.text")).alias("digest"), "_h.fp")


def parsed(titles: DataFrame, matcher: Matcher) -> DataFrame:
    """rep, person, inner, role, core of the headlines that name somebody."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = headlines.Remembering(matcher)
        for b in batches:
            hits = [(r, *hit[:4]) for r, t in zip(b["rep"], b["title"]) if (hit := headlines.parse(t, finder))]
            yield pd.DataFrame(hits, columns=["rep", "person", "inner", "role", "core"])

    return titles.select("rep", "title").mapInPandas(run, "rep bigint, person string, inner string, role bigint, core string")


def same_text(a: str, b: str) -> bool:
    """Two texts alike up to slips: one letter in short ones, two or three in long ones."""
    n = min(len(a), len(b))
    return within(a, b, 1 if n < 7 else 2 if n < 16 else 3)


@F.pandas_udf(T.BooleanType())
def _same(pa: pd.Series, pb: pd.Series, oa: pd.Series, ob: pd.Series, ia: pd.Series, ib: pd.Series) -> pd.Series:
    rows = zip(pa, pb, oa, ob, ia, ib)
    return pd.Series([(not x or not y or x == y) and same_text(p, q) and same_text(o, r) for p, q, o, r, x, y in rows], dtype=bool)


def open_store(spark: SparkSession, path: str, parts: int = PARTS) -> Store:
    """The history kept in a folder, or a new one; `parts` should keep a part of a table at a few MB."""
    return Store.open(spark, path, {"parts": parts})


def block_rows(texts: DataFrame) -> DataFrame:
    """key, fp, rep: each fingerprint under its block pair in each of the nine tables."""
    mask = (1 << headlines.BLOCK) - 1
    cut = lambda at: f"(shiftrightunsigned(fp, {at}) & {mask}L)"
    keys = []
    for i in range(3):
        for j in range(3):
            first, second = cut(i * headlines.BLOCK), cut(headlines.HALF + j * headlines.BLOCK)
            keys.append(F.expr(f"CAST({3 * i + j} << {2 * headlines.BLOCK} | {first} << {headlines.BLOCK} | {second} AS INT)"))
    return texts.select(F.explode(F.array(*keys)).alias("key"), "fp", "rep")


def near(fresh: DataFrame, known: DataFrame) -> DataFrame:
    """a, b: every pair of a fresh fingerprint with another that differs from it in at most MAX_BITS bits of each half.

    known (key, fp, rep, old): pairs of two fresh ones are formed once.
    """
    left = fresh.select("key", F.col("fp").alias("fa"), F.col("rep").alias("a"))
    pairs = join_split(left, known.select("key", F.col("fp").alias("fb"), F.col("rep").alias("b"), "old"), ["key"])
    low = (1 << headlines.HALF) - 1
    close = f"bit_count((fa ^ fb) & {low}L) <= {MAX_BITS} AND bit_count(shiftrightunsigned(fa ^ fb, {headlines.HALF})) <= {MAX_BITS}"
    return pairs.filter("a <> b AND (old OR b < a)").filter(close).select("a", "b").distinct()


def _met(store: Store, table: str, schema: T.StructType, df: DataFrame, key: str) -> DataFrame:
    """df (key, rep, ...) with the store's rep where it has the key already, and whether the key is new."""
    parts = store.settings["parts"]
    df = df.withColumn("part", part_of(key, parts=parts))
    if not store.parts.get(table):
        return df.withColumn("new", F.lit(True))
    df = stored(df, table)
    held = store.read(table, schema, touched_parts(df, parts)).select(key, F.col("rep").alias("_rep"))
    return df.join(held, key, "left").withColumn("new", F.col("_rep").isNull()).withColumn("rep", F.coalesce("_rep", "rep")).drop("_rep")


def _of_parts(store: Store, table: str, schema: T.StructType, keys: DataFrame, key: str) -> DataFrame:
    """The parts of a table that can hold these keys; in a new store all of them."""
    parts = store.settings["parts"]
    if not store.version:
        return store.read(table, schema).drop("part")
    return store.read(table, schema, touched_parts(keys.select(part_of(key, parts=parts)), parts)).drop("part")


def roots(store: Store, nodes: DataFrame, whole: bool = False) -> DataFrame:
    """node, root: follows the store's parents up to the announcement. A hop reads the parts of the nodes
    it is at (all of them if `whole`); there are at most as many hops as commits that joined announcements."""
    x = nodes.select("node", F.col("node").alias("root")).distinct()
    if not store.parts.get("parents"):
        return x
    x, open_ = stored(x, "roots"), None
    done = []
    while open_ is None or not open_.isEmpty():
        at = x if open_ is None else open_
        table = store.read("parents", PARENTS).drop("part") if whole else _of_parts(store, "parents", PARENTS, at.select(F.col("root").alias("node")), "node")
        step = stored(at.join(table.select(F.col("node").alias("root"), "parent"), "root", "left"), "roots")
        done.append(step.filter("parent IS NULL").select("node", "root"))
        open_ = step.filter("parent IS NOT NULL").select("node", F.col("parent").alias("root"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def accept(store: Store, rows: DataFrame, matcher: Matcher) -> Store:
    """The store after a batch of rows (id, page, title, digest, fp), committed."""
    parts = store.settings["parts"]
    had = bool(store.parts)
    put = lambda table, df, key: store.write(table, df.select(part_of(key, parts=parts), *df.columns), replace=False)
    pages = rows.filter("page IS NOT NULL").groupBy("page").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    texts = rows.filter("fp IS NOT NULL").groupBy("digest").agg(F.min(F.struct("id", "title", "fp")).alias("_m"), F.count("*").alias("n"))
    texts = texts.select("digest", F.col("_m.id").alias("rep"), F.col("_m.title").alias("title"), F.col("_m.fp").alias("fp"), "n")
    pages = stored(_met(store, "pages", PAGES, pages, "page"), "pages")
    texts = stored(_met(store, "texts", TEXTS, texts, "digest"), "texts")
    fresh = texts.filter("new")
    store.write("pages", pages.filter("new").select("part", "page", "rep"), replace=False)
    store.write("texts", fresh.select("part", "digest", "rep"), replace=False)
    put("titles", fresh.select("rep", "title"), "rep")

    # candidates: exact block match, then Hamming distance
    cut = stored(block_rows(fresh), "cut")
    known = cut.withColumn("old", F.lit(False))
    if had:
        known = known.unionByName(stored(_of_parts(store, "blocks", BLOCKS, cut, "key").withColumn("old", F.lit(True)), "known"))
    put("blocks", cut, "key")
    pairs = stored(near(cut, known), "near")

    # text: of the headlines in question, the ones that name somebody, then the pairs that say the same
    met = pairs.select(F.explode(F.array("a", "b")).alias("rep")).unionByName(texts.filter("n > 1 OR NOT new").select("rep")).distinct()
    met = stored(met, "met")
    said = stored(parsed(_of_parts(store, "titles", TITLES, met, "rep").join(met, "rep"), matcher), "said")
    side = lambda s: said.select(*[F.col(c).alias(f"{c}_{s}") for c in ("person", "inner", "role", "core")], F.col("rep").alias(s))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter("role_a = role_b")
    alike = both.filter(_same("person_a", "person_b", "core_a", "core_b", "inner_a", "inner_b")).select("a", "b")
    spoken = said.select("rep")
    if store.parts.get("named"):
        spoken = spoken.join(_of_parts(store, "named", NAMED, met, "rep"), "rep", "left_anti")
    put("named", spoken, "rep")

    # a page and the headline on it; a headline seen once stands for its own row
    on = rows.filter("page IS NOT NULL AND fp IS NOT NULL").select("page", "digest").distinct()
    speaks = texts.join(said.select("rep", F.lit(True).alias("_named")), "rep", "left").filter("_named OR (n = 1 AND new)")
    on = join_counted(on, pages.select("page", F.col("rep").alias("a"), "n"), "page", "n")
    on = join_counted(on, speaks.select("digest", F.col("rep").alias("b"), "n"), "digest", "n")
    links = stored(alike.unionByName(on.select("a", "b").filter("a <> b")), "links")
    if had:  # contract what history already joined
        up = roots(store, links.select(F.explode(F.array("a", "b")).alias("node")))
        for c in ("a", "b"):
            links = links.join(up.select(F.col("node").alias(c), "root"), c).drop(c).withColumnRenamed("root", c)
    merged = components(links, "a", "b")
    put("parents", merged.filter("node <> label").select("node", F.col("label").alias("parent")), "node")
    for x in (cut, pairs, met, said):
        discard(x)
    return store.commit()


def repeats(rows: DataFrame, store: Store) -> DataFrame:
    """first_id, id for every row that isn't the first of its announcement."""
    counted = lambda key: rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    whole = lambda table, schema: store.read(table, schema).drop("part")
    pages = whole("pages", PAGES).join(counted("page"), "page")
    texts = whole("texts", TEXTS).join(whole("named", NAMED), "rep", "left_semi").join(counted("digest"), "digest")
    x = join_counted(rows.select("id", "page", "digest"), pages.withColumnRenamed("rep", "_p"), "page", "n", "left")
    x = join_counted(x.select("id", "digest", "_p"), texts.withColumnRenamed("rep", "_t"), "digest", "n", "left")
    x = stored(x.select("id", F.coalesce("_p", "_t", "id").alias("node")), "rows")
    top = roots(store, x.select("node"), whole=True)
    heavy = x.groupBy("node").agg(F.count("*").alias("n")).join(top, "node")
    return join_counted(x, heavy, "node", "n").select(F.col("root").alias("first_id"), "id").filter("first_id < id")
