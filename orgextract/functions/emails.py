"""E-mail functions (E1-E12) and gates (P5-P7) as column expressions.

Null text has no addresses: finders give empty arrays, scalars give ''.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orgextract import profiles as p
from orgextract.functions.urls import is_org_domain

_CF = r'data-cfemail="([0-9a-fA-F]+)"'


def find_emails(text: Column) -> Column:
    """All matches in order; the cheap test for '@' comes first."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.contains(t, F.lit("@")), F.regexp_extract_all(t, F.lit(p.EMAIL), 0)).otherwise(F.array().cast("array<string>"))


def is_email(c: Column) -> Column:
    """E2."""
    return F.coalesce(c.rlike(f"^(?:{p.EMAIL})$"), F.lit(False))


def deobfuscate(c: Column, profile: str = "C") -> Column:
    """A also rewrites the bare words " at " and " dot " (in prose too), B replaces literally and
    in this case only, C needs brackets and resolves character entities first."""
    rep = F.regexp_replace
    if profile == "A":
        t = rep(rep(c, r"(?i)\s*\[at\]\s*|\s+at\s+", "@"), r"(?i)\s*\[dot\]\s*|\s+dot\s+", ".")
        return F.replace(F.replace(t, F.lit(" (at) "), F.lit("@")), F.lit(" (dot) "), F.lit("."))
    if profile == "B":
        for word, sign in (("[at]", "@"), ("(at)", "@"), (" at ", "@"), ("[dot]", "."), ("(dot)", "."), (" dot ", ".")):
            c = F.replace(c, F.lit(word), F.lit(sign))
        return c
    c = html_unescape(c)
    return rep(rep(c, r"(?i)\s*\[at\]\s*|\s*\(at\)\s*", "@"), r"(?i)\s*\[dot\]\s*|\s*\(dot\)\s*", ".")


@F.pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def html_unescape(c: Column) -> Column:
    """The full HTML5 table; only texts with an ampersand cross to Python."""
    return F.coalesce(_unescape(F.when(F.contains(c, F.lit("&")), c)), c)


def decode_cf(hex_text: Column) -> Column:
    """E5: XOR with the first byte; '' for short or bad input; an odd last digit is a value of its own."""
    byte = lambda at, n: F.conv(F.substring(hex_text, at, n), 16, 10).cast("int")
    chars = F.transform(
        F.sequence(F.lit(3), F.length(hex_text), F.lit(2)), lambda i: F.char(byte(i, F.lit(2)).bitwiseXOR(byte(F.lit(1), F.lit(2))))
    )
    return F.when(hex_text.rlike("^[0-9a-fA-F]{4,}$"), F.array_join(chars, "")).otherwise("")


def find_cf(text: Column) -> Column:
    """E6."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_CF), 1)


def extract_all(text: Column) -> Column:
    """Decoded and plain addresses, each once, in order."""
    t = deobfuscate(F.coalesce(text, F.lit("")), "B")
    found = F.array_distinct(F.concat(F.transform(find_cf(t), decode_cf), find_emails(t)))
    return F.filter(found, lambda e: e != "")


def email_domain(email: Column) -> Column:
    """After the first @, lower case; '' if none."""
    return F.lower(F.regexp_extract(F.coalesce(email, F.lit("")), r"(?s)^[^@]*@(.*)$", 1))


def strip_mailto(href: Column) -> Column:
    """E9."""
    return F.substring_index(F.regexp_replace(href, "(?i)^mailto:", ""), "?", 1)


def local_part(email: Column) -> Column:
    return F.lower(F.substring_index(F.coalesce(email, F.lit("")), "@", 1))


def is_generic(email: Column, profile: str = "C") -> Column:
    """E10."""
    return local_part(email).isin(p.GENERIC_C if profile == "C" else p.GENERIC_A)


def matches_name(email: Column, name: Column) -> Column:
    """A word of at least three letters of the name is part of the local part."""
    parts = F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit("[a-z]+"), 0)
    return F.exists(parts, lambda t: (F.length(t) >= 3) & F.contains(local_part(email), t))


def best_email(candidates: Column, name: Column) -> Column:
    """First that fits the name, else first personal one, else first; '' if none is valid."""
    tidy = F.transform(candidates, lambda e: deobfuscate(F.regexp_replace(e, r"\s+", ""), "A"))
    valid = F.array_distinct(F.filter(tidy, is_email))
    first = lambda a: F.get(a, F.lit(0))
    return F.coalesce(first(F.filter(valid, lambda e: matches_name(e, name))), first(F.filter(valid, lambda e: ~is_generic(e, "A"))), first(valid), F.lit(""))


def keep_email(email: Column, source_host: Column, valid: Column, profile: str = "C") -> Column:
    """Gate on the address' domain. `valid` is an array of domains (may be empty)."""
    d, host = email_domain(email), F.lower(F.coalesce(source_host, F.lit("")))
    known = F.array_contains(valid, d)
    good = (F.coalesce(email, F.lit("")) != "") & (email != p.PLACEHOLDER)
    if profile == "B":
        return good & ((F.size(valid) == 0) | known)
    if profile == "C":
        d_, host = F.ltrim(d, F.lit("w.")), F.lower(F.ltrim(host, F.lit("w.")))
        return good & ((d_ == host) | known | is_org_domain(d, "C"))
    return good & ((d == host) | known | is_org_domain(d, "A"))


def suppress_generic(email: Column, tag: Column, keep_generic: Column) -> Column:
    """A generic mailbox from an extractor that doesn't hint at a person."""
    hinted = F.contains(tag, F.lit("leadership")) | F.contains(tag, F.lit("json-ld")) | F.contains(tag, F.lit("pdf-window"))
    return is_generic(email, "C") & ~keep_generic & ~hinted
