"""Whole-number vectors, and the cells in which blocks of asking rows meet chunks of all rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: scores of one call are held in about so many numbers
CELLS = 1 << 22


def whole_parts(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, worked out as a double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x))


def finite(vector: Column) -> Column:
    """True for a vector with components, none of them NULL, NaN or infinite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~odd, F.lit(False))


def pieces(n: int, size: int, least: int) -> int:
    """Into how many pieces of at most ``size`` rows a table of n rows goes."""
    return max(least, math.ceil(n / size), 1)


def dealt(col: str | Column, n: int, seed: int = 0) -> Column:
    """One of n pieces for a row, by a hash."""
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(n)).cast("int")


def to_all(n: int) -> Column:
    """A copy of the row for each of n pieces."""
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def longest(x: np.ndarray) -> int:
    """A whole number that no row's Euclidean length exceeds."""
    return math.isqrt(int(max(sum(int(v) * int(v) for v in row) for row in _extreme(x)))) + 1 if x.size else 0


def _extreme(x: np.ndarray) -> np.ndarray:
    """The row of the largest length in doubles, and all that come near it."""
    squares = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    return x[squares >= squares.max() * (1 - 1e-9)][:1000]


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest allowed scores of each row, the first column of equals first.

    ``scores`` are 64-bit whole numbers above the least one; the array is used up.
    """
    none = np.iinfo(np.int64).min
    scores[~allowed] = none
    every = np.arange(len(scores))
    rows, columns = [], []
    for _ in range(min(k, scores.shape[1])):
        at = scores.argmax(axis=1)
        some = scores[every, at] != none
        rows.append(every[some])
        columns.append(at[some])
        scores[every, at] = none
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(columns)


def rank_within(df: DataFrame, by: list[str], k: int, score: str, tie: str) -> DataFrame:
    """The first k rows of each group by falling score, then rising ``tie``, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
