"""What the operators on embeddings share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dimension(rows: DataFrame, vec: str) -> int:
    """The most frequent length of a vector, the larger of equals; 0 without vectors."""
    sizes = rows.where(F.col(vec).isNotNull()).groupBy(F.size(vec).alias("d")).count()
    top = sizes.agg(F.max(F.struct("count", "d"))["d"].alias("d")).first()
    return top["d"] or 0


def usable(vec: Column, dim: int) -> Column:
    """Not null, of `dim` numbers that are all finite and not all 0."""
    return F.coalesce(
        (F.size(vec) == dim) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vec, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def sample(rows: DataFrame, vec: str, dim: int, limit: int, total: int, seed: str) -> np.ndarray:
    """About `limit` vectors of `rows`, drawn by a hash of the vector."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col(vec)), F.lit(1 << 30))
    picked = rows.where(drawn < int(min(1.0, limit / max(1, total)) * (1 << 30))).select(vec).limit(2 * limit)
    table = picked.toArrow()
    x = matrix(table.column(0), dim) if table.num_rows else np.zeros((0, dim))
    return x[np.lexsort(x.T[::-1])] if len(x) else x
