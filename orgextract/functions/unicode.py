"""Unicode normalisation as column functions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def nfc(c: Column) -> Column:
    """NFC. Only texts that hold combining marks, conjoining jamo or the few singletons go to Python; others cross as nulls."""
    return F.coalesce(_nfc(F.when(c.rlike(r"[\p{M}\u1100-\u11FF\u0374\u037E\u0387\u1F00-\u1FFF\u2000\u2001\u2126\u212A\u212B\u2329\u232A\uF900-\uFAFF]"), c)), c)


def letters_digits(c: Column) -> Column:
    """Composed, lower-cased, letters and digits only; null becomes empty."""
    return F.regexp_replace(F.lower(nfc(F.coalesce(c, F.lit("")))), r"[^\p{L}\p{N}]+", "")
