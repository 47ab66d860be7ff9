"""Embedding rows that can be compared, as packed float64 vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` as doubles, without rows that are null, zero, or hold a null or non-finite component."""
    e = F.col("embedding").cast("array<double>")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    return vectors.where("vec_id IS NOT NULL").select("vec_id", e.alias("embedding")).where(fine & some)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """List rows as a matrix of ``width`` columns; shorter rows are padded with zeros, which changes no product."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def width_of(vectors: DataFrame) -> int:
    return vectors.agg(F.max(F.size("embedding"))).first()[0] or 0


def sample(vectors: DataFrame, size: int, width: int) -> np.ndarray:
    """At most ``size`` rows, those of smallest hash, so that reruns agree; a bounded matrix on the driver."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).select("embedding").toArrow()
    return matrix(rows["embedding"], width) if rows.num_rows else np.zeros((0, width))
