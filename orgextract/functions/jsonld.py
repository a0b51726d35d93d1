"""JSON-LD people (J1-J3) with VARIANT functions: tolerant parsing, no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCRIPT = r"(?is)<script[^>]*type\s*=\s*[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"
GROUPS = ["employee", "employees", "member", "members", "staff", "person", "people"]


def scripts(html: Column) -> Column:
    """Bodies of JSON-LD scripts."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_SCRIPT), 1)


def _get(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def _first(*cs: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs], F.lit(""))


def people(df: DataFrame, keys: list[str], body: str, needs_email: bool = False) -> DataFrame:
    """keys, role, name, email of persons in a JSON document per row; bad JSON gives none.

    A top object counts if it is a Person or has an address and a position; then members of
    the listed groups, as list or object; every object of a top array counts.
    """
    x = df.select(*keys, F.try_parse_json(F.col(body)).alias("_v")).filter("_v IS NOT NULL")
    x = x.withColumn("_kind", F.substring(F.schema_of_variant("_v"), 1, 6))
    top = x.filter("_kind = 'OBJECT'")
    contact = _first(_get(F.col("_v"), "$.email"), _get(F.col("_v"), "$.emailAddress"))
    position = _first(_get(F.col("_v"), "$.jobTitle"), _get(F.col("_v"), "$.role"))
    own = top.filter((_get(F.col("_v"), "$['@type']") == "Person") | ((contact != "") & (position != ""))).select(*keys, F.col("_v").alias("_p"))
    grouped = top.select(*keys, F.explode(F.array_compact(F.array(*[F.try_variant_get("_v", f"$.{g}", "variant") for g in GROUPS]))).alias("_g"))
    single = grouped.filter(F.schema_of_variant("_g").startswith("OBJECT")).select(*keys, F.col("_g").alias("_p"))
    listed = grouped.filter(F.schema_of_variant("_g").startswith("ARRAY")).select(*keys, F.explode(F.try_variant_get("_g", "$", "array<variant>")).alias("_p"))
    array = x.filter("_kind = 'ARRAY<'").select(*keys, F.explode(F.try_variant_get("_v", "$", "array<variant>")).alias("_p"))
    every = own.unionByName(single).unionByName(listed).unionByName(array).filter(F.schema_of_variant("_p").startswith("OBJECT"))
    p = F.col("_p")
    out = every.select(
        *keys,
        _first(_get(p, "$.jobTitle"), _get(p, "$.role")).alias("role"),
        _first(_get(p, "$.name")).alias("name"),
        _first(_get(p, "$.email"), _get(p, "$.emailAddress")).alias("email"),
    )
    return out.filter("email <> ''" if needs_email else "role <> '' OR name <> '' OR email <> ''")
