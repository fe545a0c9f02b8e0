"""String similarity: 1 - (insertions + deletions) / (length a + length b)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .text import _c


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, with bit-parallel rows."""
    places: dict[str, int] = {}
    for i, char in enumerate(a):
        places[char] = places.get(char, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for char in b:
        hit = row & places.get(char, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def text_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 1.0 - (total - 2 * common_subsequence(a, b)) / total if total else 1.0


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else text_ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def ratio(a: Column | str, b: Column | str) -> Column:
    return _ratio(_c(a), _c(b))


def may_reach(a: Column, b: Column, threshold: float) -> Column:
    """Necessary condition for ``ratio(a, b) >= threshold``, inside the JVM.

    The edit distance never exceeds insertions plus deletions.
    """
    budget = F.floor(F.lit(1 - threshold + 1e-9) * (F.char_length(a) + F.char_length(b))).cast("int")
    return F.call_function("levenshtein", a, b, budget) >= 0


@F.pandas_udf(DoubleType())
def _mean_ratio(left: pd.DataFrame, right: pd.DataFrame) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    means = []
    for a, b in zip(left.itertuples(index=False, name=None), right.itertuples(index=False, name=None)):
        scores = []
        for x, y in zip(a, b):
            if x and y:
                if (x, y) not in known:
                    known[x, y] = text_ratio(x, y)
                scores.append(known[x, y])
        means.append(sum(scores, 0.0) / len(scores) if scores else 0.0)
    return pd.Series(means, dtype="float64")


def mean_ratio(pairs: list[tuple[Column, Column]]) -> Column:
    """Mean ratio over the pairs of which both sides are non-empty; 0 when none is.

    One call for all pairs; equal texts of a batch are compared once.
    """
    lowered = [[F.lower(c).alias(f"f{i}") for i, c in enumerate(side)] for side in zip(*pairs)]
    return _mean_ratio(F.struct(*lowered[0]), F.struct(*lowered[1]))
