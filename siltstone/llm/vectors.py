"""Vectors as exact integers, and their columns in Arrow batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest integer component, either sign: squared distances of 64 components and more fit in 64 bits.
MOST = 2**27


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) per component as array<int>; null where a component is null, not finite or beyond MOST."""
    vector = vector.cast("array<double>")
    fits = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (x * scale >= -MOST) & (x * scale < MOST + 1), F.lit(False)))
    return F.when(fits, F.transform(vector, lambda x: F.floor(x * scale).cast("int")))


def finite(vector: Column) -> Column:
    """Whether the vector is there and all its components are numbers."""
    return F.coalesce(F.forall(vector.cast("array<double>"), lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def matrix(column, width: int, dtype=np.int64) -> np.ndarray:
    """An Arrow list column whose lists all hold ``width`` numbers, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), width)


def lists(rows: np.ndarray, kind):
    """Rows of equal length as an Arrow list column."""
    import pyarrow as pa

    n, width = rows.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.reshape(-1), type=kind))


def joined(numbers) -> str:
    """Decimal integers joined by commas, the text that digests of codebooks and centroids are taken of."""
    return ",".join(str(int(x)) for x in numbers)


def sums(rows: DataFrame, keys: list[str], vector: str, width: int) -> list:
    """Rows (keys, n, total) with the exact componentwise total of each key's vectors; few keys, so they are collected."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.array(*(F.sum(F.get(vector, i)) for i in range(width))).alias("total")).collect()
