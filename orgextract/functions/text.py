"""Text functions (T1-T22): roles, names, spans with offsets, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgextract import profiles as p


_ROLE_B = rf"(?i)\b(?:{'|'.join(p.ROLES_B)})\b"


def strip_tags(html: Column) -> Column:
    """Each tag becomes a space; script text stays."""
    return F.regexp_replace(html, "<[^>]+>", " ")


def infer_role_b(text: Column) -> Column:
    """The longest match over all patterns; ties to the earlier pattern, then the earlier place.

    One alternation tells texts without any role, so only the others meet every pattern.
    """
    t, n = F.coalesce(text, F.lit("")), len(p.ROLES_B)

    def hits_of(i: int, role: str) -> Column:
        found = F.regexp_extract_all(t, F.lit(rf"(?i)\b{role}\b"), 0)
        return F.transform(found, lambda m, j: F.struct(F.length(m).alias("l"), F.lit(n - i).alias("r"), (-j).alias("o"), m.alias("m")))

    hits = F.flatten(F.array(*[hits_of(i, r) for i, r in enumerate(p.ROLES_B)]))
    return F.when(t.rlike(_ROLE_B), F.coalesce(F.array_max(hits)["m"], F.lit(""))).otherwise("")


def role_first_c(text: Column) -> Column:
    """T4: the first match, '' if none."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), p.ROLES_C, 1)


def roles_a(text: Column) -> Column:
    """All matches; the open tail "of ..." may take in words after the role."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p.ROLES_A), 1)


def is_leadership(role: Column) -> Column:
    """T5."""
    return F.coalesce(role.rlike(_ROLE_B), F.lit(False))


def first_name(text: Column, profile: str = "C") -> Column:
    """The first capitalised run."""
    return F.regexp_extract(F.coalesce(text, F.lit("")), {"A": p.NAME_A, "B": p.NAME_B, "C": p.NAME_C}[profile], 1)


def is_service_role(role: Column) -> Column:
    """T7."""
    return F.coalesce(role.rlike(rf"(?i){'|'.join(p.SERVICE_ROLES)}"), F.lit(False))


def blank_bad_name(name: Column) -> Column:
    """T8."""
    return F.when(name.isin(p.BAD_NAME_TOKENS), "").otherwise(name)


def spans(df: DataFrame, keys: list[str], text: str, pattern: str, group: int = 0) -> DataFrame:
    """Keys, ord, start, end, match for every match, offsets 0-based in code points.

    Gaps and matches are columns of their own; running lengths give the offsets, in the JVM.
    """
    x = df.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    x = x.withColumn("_m", F.regexp_extract_all("_t", F.lit(pattern), 0)).withColumn("_g", F.split("_t", pattern, -1))
    x = x.filter(F.size("_m") > 0)
    pieces = F.zip_with("_g", "_m", lambda g, m: F.struct(F.length(g).alias("g"), m.alias("m")))
    x = x.withColumn("_p", F.filter(pieces, lambda s: s["m"].isNotNull()))
    ends = F.aggregate(
        "_p", F.array(F.lit(0)), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s["g"] + F.length(s["m"])))
    )
    x = x.withColumn("_e", F.slice(ends, F.lit(2), F.size("_p")))
    x = x.select(*keys, F.posexplode(F.zip_with("_p", "_e", lambda s, e: F.struct(s["m"].alias("m"), e.alias("e")))).alias("ord", "_s"))
    match = F.col("_s.m") if group == 0 else F.regexp_extract("_s.m", pattern, group)
    return x.select(*keys, "ord", (F.col("_s.e") - F.length("_s.m")).alias("start"), F.col("_s.e").alias("end"), match.alias("match"))


def window_around(text: Column, needle: Column, behind: int, after: int) -> Column:
    """From `behind` characters before the needle's first place to `after` past its end; '' if absent."""
    at = F.position(needle, text)
    start = F.greatest(at - behind, F.lit(1))
    return F.when(at > 0, F.substring(text, start, at + F.length(needle) + after - start)).otherwise("")


def chunks(text: Column) -> Column:
    """Phrases between line ends and separators, trimmed, none empty."""
    parts = F.transform(F.split(text, r"[\n\r,;•·|\-]"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.filter(parts, lambda x: x != "")


def lines(text: Column) -> Column:
    """T13."""
    return F.filter(F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")


def truncated(text: Column, n: int = 400_000) -> Column:
    """T14."""
    return F.left(text, F.lit(n))


def is_announcement(text: Column) -> Column:
    """A whole key phrase."""
    return F.coalesce(text.rlike(p.ANNOUNCEMENT), F.lit(False))


def joined_or_na(items: Column) -> Column:
    """T19."""
    return F.coalesce(F.nullif(F.array_join(items, ", "), F.lit("")), F.lit("N/A"))


def utc_string(ts: Column) -> Column:
    """T21."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
