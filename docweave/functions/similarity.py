"""Name similarity: the Ratcliff/Obershelp ratio, in Arrow batches, and what bounds it from above without Python."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def ratio(new: str, known: str) -> float:
    """2 * matching characters / all characters; the order of arguments matters."""
    return difflib.SequenceMatcher(None, new, known).ratio()


@F.pandas_udf(DoubleType())
def ratios(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for new, known in pairs:
        yield pd.Series([ratio(a, b) for a, b in zip(new, known)], dtype="float64")


def length_bound(new: Column, known: Column, least: float) -> Column:
    """True wherever the ratio can be ``least`` or more: matches are at most the shorter length."""
    a, b = F.length(new), F.length(known)
    return 2.0 * F.least(a, b) >= least * (a + b) - 1e-9
