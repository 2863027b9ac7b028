"""Vectors as rows of integers, for the operators on embeddings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def length(df: DataFrame, vector: str) -> int:
    """Components of the longest vector; 0 without any."""
    return df.agg(F.max(F.size(vector))).first()[0] or 0


def whole(vector: Column, scale: int, limit: int) -> Column:
    """floor(scale * x) of every component, cut to +-limit."""
    floor = lambda x: F.floor(x.cast("double") * F.lit(float(scale)))
    return F.transform(vector, lambda x: F.greatest(F.lit(-limit), F.least(F.lit(limit), floor(x))).cast("long"))


def limit_of(terms: int) -> int:
    """The largest component for which a sum of so many products of two components fits 64 bits."""
    return math.isqrt(((1 << 63) - 1) // max(terms, 1))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of 64-bit integers; shorter rows end in zeros."""
    ends = column.offsets.to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    lengths = np.diff(ends)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact.

    Floating point is used where every partial sum is a whole number that it holds exactly, which is faster.
    """
    most = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    bound = most(left) * most(right) * left.shape[1]
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)
