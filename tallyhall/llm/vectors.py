"""What the vector operators share: valid rows, bytes of matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str = "embedding") -> Column:
    """Whether a vector is there, not empty, and holds finite numbers only."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & good, F.lit(False))


def doubles(df: DataFrame) -> DataFrame:
    """``vec_id, embedding`` as long and doubles (float values keep their value)."""
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def matrix(column, dim: int) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
