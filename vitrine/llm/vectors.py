"""Integer vectors from an embedding column, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def whole(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite."""
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def quantised(vector: Column) -> Column:
    """Every entry c as the long floor(256 * c); beyond a long, its nearest one."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def of_common_length(df: DataFrame, column: str) -> DataFrame:
    """Rows whose array has the length that most rows have (ties: the shortest)."""
    sizes = (df.groupBy(F.size(column).alias("length")).count()
             .orderBy(F.desc("count"), "length").limit(2).collect())
    return df if len(sizes) < 2 else df.where(F.size(column) == sizes[0]["length"])


def matrix(column: pa.Array, dtype=np.int64) -> np.ndarray:
    """An Arrow list column without NULLs as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(dtype, copy=False) if len(column) else np.zeros((0, 0), dtype)


def peak(x: np.ndarray) -> int:
    """The largest magnitude, as a Python integer."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices: in floating
    point while every partial sum is below 2^53, else as longs, else as integers
    of any size (an object matrix)."""
    most = peak(a) * peak(b) * max(a.shape[-1], 1)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return a.astype(object) @ b.astype(object).T
