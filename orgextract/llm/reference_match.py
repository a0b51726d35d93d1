"""Free-typed values to the closest entry of a reference list (problem 3).

A BK-tree over the written forms of the reference entries, under Levenshtein distance,
returns every form within the threshold; the nearest form's entry wins. A reference list
up to `broadcast_entries` travels to the workers as one tree and rows are mapped where
they lie, without a shuffle, so a value that holds a third of all rows costs one lookup
per batch. A longer list is cut into shards: each shard's tree answers for the distinct
values, and the shards' winners are merged by (stage, distance, entry).

Defined results
* null or blank values give no row; values within reach of no entry give -1;
* equal distances go to the smaller entry id; case, accents' composition, punctuation,
  word order of "X of Y" forms and remarks on place, term or acting status do not matter.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from orgextract.llm.editmetric import BKTree
from orgextract.operators.skew import join_counted
from orgextract.session import stored

# Abbreviations and foreign or variant wordings of job titles.
ABBREVIATIONS = {
    "asst": "assistant", "assoc": "associate", "bd": "board", "brd": "board", "bus": "business", "chf": "chief",
    "cmte": "committee", "comm": "committee", "comms": "committee", "compl": "compliance", "coll": "collections",
    "coord": "coordinator", "dev": "development", "dir": "director", "dirs": "directors", "exec": "executive",
    "fac": "facilities", "fin": "finance", "info": "information",
    "int": "internal", "loans": "loan", "mbr": "member", "members": "member", "mgr": "manager", "mngr": "manager",
    "mgmt": "management", "mkt": "marketing", "mktg": "marketing", "mtg": "mortgage", "mort": "mortgage",
    "off": "officer", "ofc": "officer", "ofcr": "officer", "offcr": "officer", "oper": "operations", "opers": "operations",
    "ops": "operations", "pres": "president", "rep": "representative", "res": "resources",
    "sec": "secretary", "secy": "secretary", "snr": "senior", "sr": "senior", "supv": "supervisor", "supvr": "supervisor",
    "supvy": "supervisory", "svc": "services", "svcs": "services", "service": "services", "supvry": "supervisory", "tech": "technology",
    "treas": "treasurer", "v": "vice", "hr": "human resources", "it": "information technology", "vp": "vice president",
    "evp": "executive vice president", "svp": "senior vice president", "avp": "assistant vice president",
    "chairman": "chair", "chairwoman": "chair", "chairperson": "chair", "comptroller": "controller",
    "ceo": "chief executive officer", "coo": "chief operating officer", "cfo": "chief financial officer",
    "clo": "chief lending officer", "cmo": "chief marketing officer", "cio": "chief information officer",
    "cto": "chief technology officer", "cro": "chief risk officer", "chro": "chief human resources officer",
    "cco": "chief compliance officer", "bdo": "business development officer", "msr": "member services representative",
}
PHRASES = {
    r"\bsupv y\b": "supervisory", r"\bpresidente\b": "president", r"\bgerente de sucursal\b": "branch manager",
    r"\boficial de pr[eé]stamos\b": "loan officer", r"\bdirectora? ejecutiv[ao]\b": "chief executive officer",
    r"\bassistant to the (?:ceo|chief executive officer)\b": "executive assistant",
    r"\bh r\b": "hr", r"\bi t\b": "it", r"\bv p\b": "vp", r"\bboard of directors\b": "board", r"\bdirectors\b": "board",
}
REMARKS = re.compile(
    r"\b(?:acting|interim|emeritus|emerita|elect|designate|pro tem|temporary|former|since \d{4}|as of \d{4}|\d{4} to present|term ends \d{4}|\d{4})\b"
)
#: Words for a place of work within an organisation; a remark, never part of a position.
PLACES = {"downtown", "eastside", "westside", "northside", "southside", "main", "office", "campus", "headquarters", "hq", "north",
          "south", "east", "west", "central", "uptown", "midtown", "region", "regional", "remote", "onsite"}
FILLERS = {"the", "our", "of", "and", "for", "a", "an", "to"}
#: Words that stand for each other inside a title, and other names of whole positions.
ALTERNATES = {"financial": "finance", "operating": "operations"}
SYNONYMS = {
    "Corporate Treasurer": "Treasurer", "Board Treasurer": "Treasurer", "Corporate Secretary": "Secretary",
    "Board Secretary": "Secretary", "Recording Secretary": "Secretary", "Financial Controller": "Controller",
    "Chief Executive": "Chief Executive Officer", "Chief Finance Officer": "Chief Financial Officer",
    "Chief of Finance": "Chief Financial Officer",
}
_SEPARATORS = re.compile(r"\s+[-–—]+\s+|[|;()\[\]•·]|,|\s/\s|\s@\s")


@dataclass(frozen=True)
class Lexicon:
    """The words of one domain that a matcher reads values with. Other domains load their own from a table."""

    abbreviations: dict[str, str] = field(default_factory=dict)
    phrases: dict[str, str] = field(default_factory=dict)
    alternates: dict[str, str] = field(default_factory=dict)
    synonyms: dict[str, str] = field(default_factory=dict)
    places: frozenset[str] = frozenset()
    fillers: frozenset[str] = frozenset()
    units: tuple[str, ...] = ()
    remarks: re.Pattern = re.compile(r"(?!)")

    @classmethod
    def load(cls, table: DataFrame, limit: int = 100_000) -> Lexicon:
        """From rows (kind, written, meant): kind is abbreviation, phrase (a pattern), alternate, synonym, place, filler,
        unit or remark (a pattern); the last four need no meaning. A list beyond the limit is an error."""
        rows = table.select("kind", "written", "meant").limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"a lexicon holds at most {limit} rows")
        of = lambda kind: {w: m for k, w, m in rows if k == kind}
        remarks = "|".join(of("remark"))
        return cls(
            of("abbreviation"), of("phrase"), of("alternate"), of("synonym"), frozenset(of("place")), frozenset(of("filler")), tuple(of("unit")),
            re.compile(rf"\b(?:{remarks})\b" if remarks else r"(?!)"),
        )


def plain(text: str) -> str:
    text = unicodedata.normalize("NFC", text).lower()
    text = re.sub("[\u200B\uFEFF]", "", text).replace("&", " and ")
    return " ".join(re.findall(r"[^\W_]+", text))


#: Titles of jobs.
JOB_TITLES = Lexicon(
    ABBREVIATIONS, PHRASES, ALTERNATES, SYNONYMS, frozenset(PLACES), frozenset(FILLERS),
    ("vice president", "human resources", "information technology", "vice chair"), REMARKS,
)


def words(text: str, lexicon: Lexicon = JOB_TITLES) -> list[str]:
    """Expanded content words, in order; spelled-out initials ("c e o") joined first."""

    def initials(m: re.Match) -> str:
        joined = m.group().replace(" ", "")
        return joined if joined in lexicon.abbreviations else m.group()

    text = re.sub(r"\b(?:[a-z] )+[a-z]\b", initials, plain(text))
    for pattern, by in lexicon.phrases.items():
        text = re.sub(pattern, by, text)
    text = lexicon.remarks.sub(" ", text)
    out = []
    for w in text.split():
        out += lexicon.abbreviations.get(w, w).split()
    return [w for w in out if w not in lexicon.fillers]


def forms(canonical: str, short: str | None, lexicon: Lexicon = JOB_TITLES) -> set[str]:
    """Written forms of one entry: its units ("vice president", "human resources") in every order."""
    base = words(canonical, lexicon)
    joined = " ".join(base)
    for unit in lexicon.units:
        joined = joined.replace(unit, unit.replace(" ", "_"))
    units = joined.split()
    out = {" ".join(p).replace("_", " ") for p in itertools.permutations(units)} if len(units) <= 4 else {" ".join(base)}
    for a, b in lexicon.alternates.items():
        out |= {re.sub(rf"\b{a}\b", b, f) for f in out} | {re.sub(rf"\b{b}\b", a, f) for f in out}
    if short:
        out.add(plain(short))
    return out


class Matcher:
    """Maps one text to (distance, entry id); picklable, holds one shard of the reference list."""

    def __init__(self, entries: list[tuple[int, str, str | None]], synonyms: dict[str, str] | None = None, lexicon: Lexicon = JOB_TITLES):
        self.lexicon = lexicon
        synonyms = lexicon.synonyms if synonyms is None else synonyms
        by_name = {plain(c): i for i, c, _ in entries}
        items: dict[str, list[int]] = {}
        for i, canonical, short in sorted(entries):
            for form in forms(canonical, short, lexicon):
                items.setdefault(form, []).append(i)
        for form, canonical in synonyms.items():
            if plain(canonical) in by_name:
                items.setdefault(" ".join(words(form, lexicon)), []).append(by_name[plain(canonical)])
        self.tree = BKTree(items)

    @staticmethod
    def reach(text: str) -> int:
        return 0 if len(text) <= 4 else 1 if len(text) <= 7 else 2 if len(text) <= 16 else 3

    def nearest(self, text: str) -> tuple[int, int] | None:
        if not text:
            return None
        if text in self.tree.values:
            return 0, min(self.tree.values[text])
        found = self.tree.query(text, self.reach(text))
        return (found[0][0], min(i for d, t in found if d == found[0][0] for i in self.tree.values[t])) if found else None

    def find(self, raw: str) -> tuple[int, int] | None:
        """The whole text; else without its remark: leading segments, other segments, then
        the leading or trailing words of a text that begins or ends with a written form."""
        hit = self.staged(raw)
        return hit[1:] if hit else None

    def staged(self, raw: str) -> tuple[int, int, int] | None:
        """(stage, distance, entry id) of the first reading in find()'s order that has a hit."""
        read = lambda text: words(text, self.lexicon)
        whole = read(raw)
        parts = [p for p in _SEPARATORS.split(raw) if re.search(r"\w", p)]
        split_case = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", raw)
        placeless = [x for x in whole if x not in self.lexicon.places]
        readings = itertools.chain(
            [whole],
            (read(p) for p in [" ".join(parts[:n]) for n in range(len(parts) - 1, 0, -1)] + parts[1:]),
            (read(x) for x in [split_case if split_case != raw else ""]),
            [placeless if len(placeless) < len(whole) else []],
        )
        for stage, reading in enumerate(readings):
            if hit := self.nearest(" ".join(reading)):
                return stage, *hit
        return None


#: Values a worker remembers; beyond that it starts over.
CACHED_VALUES = 200_000


def map_to_reference(df: DataFrame, id_col: str, value: str, matcher: Matcher) -> DataFrame:
    """id, ref_id: the entry each non-blank value means, or -1. One tree per worker, no shuffle."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, int] = {}
        for s in batches:
            codes, uniques = pd.factorize(s)
            if len(known) > CACHED_VALUES:
                known.clear()
            for u in uniques:
                if u not in known:
                    hit = matcher.find(u)
                    known[u] = hit[1] if hit else -1
            yield pd.Series([known[u] for u in uniques], dtype="int32").take(codes).reset_index(drop=True)

    mapped = F.pandas_udf(run, IntegerType())
    filled = df.filter(F.col(value).rlike(r"(?U)[^\s\u200B\uFEFF]"))
    return filled.select(id_col, mapped(F.col(value)).alias("ref_id"))


#: Distinct values one task asks of one shard.
VALUES_PER_TASK = 50_000
#: The shard trees a worker has built, by run and shard; the last run's only.
_TREES: dict[tuple[str, int], Matcher] = {}


def map_to_sharded_reference(
    df: DataFrame, id_col: str, value: str, reference: DataFrame, synonyms: dict[str, str] | None, shards: int, lexicon: Lexicon = JOB_TITLES
) -> DataFrame:
    """The same for a reference list too long for one worker: (role_ref_id, canonical, short) is cut
    into shards; each distinct value is asked of every shard's tree in groups of bounded size, and the
    shard winners merge by (stage, distance, entry): a shard answers with the first reading in which it
    has a hit, so the least stage over the shards is the one the whole tree would have stopped at.
    `id_col` rows meet the answers by value."""
    values = df.filter(F.col(value).rlike(r"(?U)[^\s\u200B\uFEFF]")).select(id_col, F.col(value).alias("_v"))
    distinct = stored(values.groupBy("_v").agg(F.count("*").alias("_n")), "values")
    blocks = max(1, -(-distinct.count() // VALUES_PER_TASK))
    asked = distinct.withColumn("_block", F.pmod(F.xxhash64("_v"), F.lit(blocks)).cast("int")).withColumn(
        "_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    trees = reference.withColumn("_shard", F.pmod(F.xxhash64("role_ref_id"), F.lit(shards)).cast("int")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    run = uuid.uuid4().hex

    def answer(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        from orgextract.llm.reference_match import _TREES

        at = run, int(key[0])
        if at not in _TREES:
            for old in [k for k in _TREES if k[0] != run]:
                del _TREES[old]
            _TREES[at] = Matcher([(int(i), c, s) for i, c, s in zip(right.role_ref_id, right.canonical, right.short)], synonyms, lexicon)
        m = _TREES[at]
        hits = [(v, *hit) for v in left._v if (hit := m.staged(v))]
        return pd.DataFrame(hits, columns=["_v", "_stage", "_d", "_ref"])

    winners = (
        asked.groupBy("_shard", "_block")
        .cogroup(trees.groupBy("_shard", "_block"))
        .applyInPandas(answer, "_v string, _stage int, _d int, _ref int")
        .groupBy("_v")
        .agg(F.min(F.struct("_stage", "_d", "_ref"))["_ref"].alias("_ref"))
    )
    answers = winners.join(distinct, "_v")
    return join_counted(values, answers, "_v", "_n", "left").select(id_col, F.coalesce("_ref", F.lit(-1)).alias("ref_id"))


#: A reference list up to this many entries travels whole to each worker.
BROADCAST_ENTRIES = 20_000


def match_reference(
    df: DataFrame, id_col: str, value: str, reference: DataFrame, synonyms: dict[str, str] | None = None, lexicon: Lexicon = JOB_TITLES
) -> DataFrame:
    """reference: (role_ref_id, canonical, short). Chooses the plan by the list's counted size."""
    head = reference.limit(BROADCAST_ENTRIES + 1).collect()
    if len(head) > BROADCAST_ENTRIES:
        shards = -(-reference.count() // BROADCAST_ENTRIES)
        return map_to_sharded_reference(df, id_col, value, reference, synonyms, shards, lexicon)
    return map_to_reference(df, id_col, value, Matcher([(int(r[0]), r[1], r[2]) for r in head], synonyms, lexicon))
