"""P14 ``normalize_text``: lower -> NFD -> drop punctuation -> collapse -> strip.

Spark has no Unicode normalisation function, so NFD is the one Arrow-batched
pandas UDF here; ASCII strings are already in NFD and pass through untouched.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quarry.functions import patterns as pt
from quarry.functions.text import _c, py_strip


def _nfd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFD", x))


_NFD_UDF = None


def _nfd_col(col) -> Column:
    """Unicode NFD (Arrow-batched; built lazily so workers never need a session)."""
    global _NFD_UDF
    if _NFD_UDF is None:
        _NFD_UDF = F.pandas_udf(_nfd, StringType())
    return _NFD_UDF(col)


def normalize_text(col, unicode_nfd: bool = True) -> Column:
    """P14; ``unicode_nfd=False`` skips the NFD step (valid for ASCII-only text)."""
    t = F.lower(_c(col))
    if unicode_nfd:
        t = _nfd_col(t)
    t = F.regexp_replace(t, r"\p{P}+", "")
    t = F.regexp_replace(t, f"[{pt.UNI_WS}]+", " ")
    return py_strip(t)
