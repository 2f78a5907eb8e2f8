"""Vector columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """True for vectors without null or non-finite components."""
    inf = float("inf")
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(inf))), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length as float64."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
