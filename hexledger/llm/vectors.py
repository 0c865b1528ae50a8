"""Arrow columns of vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, and all entries finite numbers."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, odd), F.lit(False))


def common_length(vectors: DataFrame, column: str) -> int:
    """The most frequent length of usable vectors (of equally frequent ones the greatest); 0 without vectors."""
    lengths = vectors.where(usable(F.col(column))).groupBy(F.size(column).alias("size")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def matrix(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold a usable vector of `length` entries, and these vectors as doubles."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), length), False)
    entries = column.filter(fits).flatten().cast(pa.float64())
    values = entries.to_numpy(zero_copy_only=False).reshape(-1, length)  # null entries become NaN
    finite = np.isfinite(values).all(axis=1)
    rows = np.flatnonzero(fits.to_numpy(zero_copy_only=False))[finite]
    return rows, values[finite]
