"""Similarities of two strings as column expressions; blank or null on either side means 0, or -1 for agreement."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lakeloom.functions.normalize import tokens


def blank(a: Column, b: Column) -> Column:
    return (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")


def exact_match(a: Column, b: Column) -> Column:
    return F.when(blank(a, b), 0.0).otherwise((a == b).cast("double"))


def jaccard(a: Column, b: Column) -> Column:
    """Of the sets of words between spaces. The size of the union follows from the sizes of the sets, so that one pass over the smaller arrays is enough."""
    x, y = tokens(a), tokens(b)
    both = F.size(F.array_intersect(x, y))
    return F.when(blank(a, b) | (F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(both / (F.size(x) + F.size(y) - both))


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}  # of this batch

    def one(x: str | None, y: str | None) -> float:
        if not x or not y:
            return 0.0
        if x == y:
            return 1.0
        if (x, y) not in known:
            known[x, y] = SequenceMatcher(None, x, y).ratio()
        return known[x, y]

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def seq_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio with the usual junk heuristic for long second strings; the order of the arguments matters."""
    return _ratio(a, b)


def agreement(a: Column, b: Column) -> Column:
    return F.when(blank(a, b), -1.0).otherwise((a == b).cast("double"))
