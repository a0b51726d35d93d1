"""Packed lists: one text field holding several values in an unknown notation (problem 1).

Quoted or escaped spans are replaced by indexed placeholders, the rest is split at the
delimiter the field uses, the spans are restored through an array lookup and the items
are exploded with their places. Everything is a built-in SQL expression, so the operator
runs inside one scan stage without a shuffle; one field is never larger than its row.

Defined results
* null, blank and ``N/A`` fields, and places without a letter or digit, give no row; places count from 1;
* a comma (or "and", "&", "/") that belongs to a name stays in it: behind an escape, in a
  quoted span, before a legal or personal suffix, or inside an organisation's name;
* a name's own inner quotation marks stay; enclosing marks, brackets and escapes go;
* very long fields are handled whole; repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "\ue000", "\ue001"
_MARK = f"{OPEN}(\\d+){CLOSE}"
_BRACKETED = r"(?s)^\s*\[.*\]\s*$"
#: Spans that no delimiter may cut. Placeholder characters already in a text are spans of
#: their own, so no text can collide with a placeholder.
_SPAN = rf'(?s)"(?:[^"\\]|""|\\.)*"|“[^”]*”|«[^»]*»|\\.|[{OPEN}{CLOSE}]'
_SPAN_IN_BRACKETS = rf"(?s)'(?:[^'\\]|\\.)*'|" + _SPAN[4:]
#: A cheap test for whether a text can hold a span at all.
_MAY_HOLD_SPANS = rf'["“«\\{OPEN}{CLOSE}]'
_PADDING = r"(?U)^[\s\u200B\uFEFF]+|[\s\u200B\uFEFF]+$"
_PADDED = r"(?U)^[\s\u200B\uFEFF]|[\s\u200B\uFEFF]$"
#: Character tests that spare most texts the patterns below.
_ANY_STRONG = r"[|;•·\n\t]"
_ANY = rf"[|;•·\n\t,/&{OPEN}]|\sand\s"
_STRONG = r"\s*(?:\|+|;|•|·|\r?\n|\t)\s*"


@dataclass(frozen=True)
class Notation:
    """What may stand inside one name of a field: decides which weak delimiters separate."""

    comma: str
    conjunction: str
    slash_first: bool
    inverted: str | None


# Suffixes that follow a comma inside one name, and words that end an organisation's name.
PERSON = Notation(
    comma=r"\s*,\s*+(?!(?:[A-Z]{2,6}|Esq|Ph\.?D|Jr|Sr)\b\.?\s*(?:,|$|\s(?:and|&)\s))",
    conjunction=r"\s+(?:and|&)\s+",
    slash_first=True,
    inverted=rf"^\s*(?:(?:de|la|del|van|von|der|den|di|da|du|le|dos|el|bin|al)\s+)*[^\s,{OPEN}]+\s*,\s+[^,{OPEN}]+$",
)
ORGANIZATION = Notation(
    comma=r"\s*,\s*+(?!(?:Inc|Ltd|LLC|LLP|PLC|Corp|Co)\b|[^\s,]+ (?:&|and) (?:Partners|Associates|Sons|Company)\b)",
    conjunction=(
        r"(?<=\b(?:Union|FCU|CU|LLC|Council|Forum|Foundation|Consulting|Auditors|Cooperatives|Partners|Associates"
        rf"|Data|Association|League|Bank|Society|Institute|Group|Co-op)|Inc\.|Ltd\.|Corp\.|Inc|Ltd|{CLOSE})"
        r"\s+(?:and|&)\s+"
    ),
    slash_first=False,
    inverted=None,
)


def with_items(df: DataFrame, field: str, notation: Notation, out: str) -> DataFrame:
    """Adds `out`: array<string> of the names in the field, in order, none empty.

    Each step is a column of its own that the next one refers to more than once, so the optimizer
    keeps the steps apart and no pattern runs twice over a text.
    """
    col = lambda name: f"_packed_{out}_{name}"
    value = F.coalesce(F.col(field), F.lit(""))
    bracketed = F.contains(value, F.lit("[")) & value.rlike(_BRACKETED)
    df = df.withColumn(col("in"), bracketed).withColumn(
        col("body"), F.when(F.col(col("in")), F.regexp_replace(value, r"(?s)^\s*\[|\]\s*$", "")).otherwise(value)
    )
    body, inside = F.col(col("body")), F.col(col("in"))
    either = lambda f: F.when(inside, f(_SPAN_IN_BRACKETS)).when(body.rlike(_MAY_HOLD_SPANS), f(_SPAN)).otherwise(f(None))
    df = df.withColumn(
        col("spans"), either(lambda p: F.regexp_extract_all(body, F.lit(p), 0) if p else F.array().cast("array<string>"))
    ).withColumn(col("gaps"), either(lambda p: F.split(body, p, -1) if p else F.array(body)))
    spans = F.col(col("spans"))
    marks = F.transform(spans, lambda s, i: F.concat(F.lit(OPEN), i.cast("string"), F.lit(CLOSE)))
    masked = F.array_join(F.zip_with(col("gaps"), marks, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    df = df.withColumn(col("masked"), masked)
    items = F.transform(_cut(F.col(col("masked")), notation), lambda item: _restore(item, spans))
    items = F.transform(items, lambda x: F.when(x.rlike(_PADDED), F.regexp_replace(x, _PADDING, "")).otherwise(x))
    df = df.withColumn(out, F.filter(items, lambda x: x.rlike(r"[\p{L}\p{N}]") & (F.lower(x) != "n/a")))
    return df.drop(*[col(n) for n in ("in", "body", "spans", "gaps", "masked")])


def _cut(masked: Column, n: Notation) -> Column:
    by = lambda pattern: F.split(masked, pattern, -1)
    has = lambda pattern: masked.rlike(pattern)
    conj = lambda item: F.split(F.regexp_replace(item, r"^\s*(?:and|&)\s+", ""), n.conjunction, -1)
    listed = F.flatten(F.transform(by(n.comma), conj))
    slashed = by(r"\s+/\s+")
    cases = F.when(~has(_ANY), F.array(masked)).when(has(_ANY_STRONG), by(_STRONG)).when(has(rf"^\s*(?:{_MARK}\s*)+$"), by(rf"(?<={CLOSE})\s*(?={OPEN})"))
    if n.slash_first:
        cases = cases.when(has(r"\s/\s"), slashed)
    if n.inverted:
        cases = cases.when(has(n.inverted) & ~has(n.conjunction), F.array(masked))
    if not n.slash_first:
        cases = cases.when(has(r"\s/\s") & ~has(n.comma), slashed)
    return cases.otherwise(listed)


def _restore(item: Column, spans: Column) -> Column:
    item = F.trim(item)
    at = F.regexp_extract_all(item, F.lit(_MARK), 1)
    span = lambda k: F.element_at(spans, k.cast("int") + 1)
    pieces = F.split(item, _MARK, -1)
    inner = lambda s: F.when(s.startswith("\\"), F.substring(s, 2, 1)).otherwise(s)
    mixed = F.array_join(
        F.transform(pieces, lambda p, i: F.when(i < F.size(at), F.concat(p, inner(span(F.get(at, i))))).otherwise(p)), ""
    )
    first = span(F.get(at, F.lit(0)))
    content = F.substring(first, F.lit(2), F.length(first) - 2)
    unescaped = F.regexp_replace(F.regexp_replace(content, '""', '"'), r"\\(.)", "$1")
    alone = item.rlike(rf"^{_MARK}$") & ~first.startswith("\\")
    return F.when(~F.contains(item, F.lit(OPEN)), item).when(alone, unescaped).otherwise(mixed)


def explode_packed(df: DataFrame, keys: list[str], fields: dict[str, Notation]) -> DataFrame:
    """keys, field_name, item_pos, item: one row per name of every named field."""
    for i, (f, n) in enumerate(fields.items()):
        df = with_items(df, f, n, f"_items{i}")
    lists = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"_items{i}").alias("items")) for i, f in enumerate(fields)])
    return (
        df.select(*keys, F.explode(lists).alias("_f"))
        .select(*keys, F.col("_f.field_name").alias("field_name"), F.posexplode("_f.items").alias("_p", "item"))
        .select(*keys, "field_name", (F.col("_p") + 1).cast("int").alias("item_pos"), "item")
    )
