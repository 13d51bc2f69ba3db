"""Matching-block similarity of texts as Arrow-batched functions.

The ratio is asymmetric and skips frequent characters of long second texts, so it is taken from difflib
itself, with the arguments in the order given.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from .text import ASCII_PUNCTUATION, WIDE_PUNCTUATION

PREFIX_THRESHOLD, SHORT_DISCOUNT, SHORT_LENGTH = 0.65, 0.2, 5
_PUNCTUATION = str.maketrans(dict(zip(WIDE_PUNCTUATION, ASCII_PUNCTUATION)) | {"…": "..."})


def ratio_of(a: str, b: str) -> float:
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


def is_fuzzy_prefix(shorter: str | None, longer: str | None, threshold: float = PREFIX_THRESHOLD) -> bool:
    """The shorter text is close to the beginning of the longer one; more tolerant up to five characters."""
    if shorter is None or longer is None or len(shorter) >= len(longer) or len(shorter) < 2:
        return False
    short, long = shorter.translate(_PUNCTUATION), longer.translate(_PUNCTUATION)
    return ratio_of(short, long[: len(short)]) >= (threshold - SHORT_DISCOUNT if len(shorter) <= SHORT_LENGTH else threshold)


def ratio(a: Column, b: Column) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else ratio_of(p, q) for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(run, DoubleType())(a, b)


def fuzzy_prefix(shorter: Column, longer: Column, threshold: float = PREFIX_THRESHOLD) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([is_fuzzy_prefix(p, q, threshold) for p, q in zip(x, y)], dtype="bool")

    return F.pandas_udf(run, BooleanType())(shorter, longer)
