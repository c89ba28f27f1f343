"""Vectors as integers: each component times 1024, rounded down."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024


def usable(vector: Column) -> Column:
    """Whether a vector is there and every component is a finite number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def integers(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the usable vectors; x holds floor(1024 * component), taken as doubles."""
    vector = F.col(vector_col)
    return df.where(usable(vector)).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)).alias("x"),
    )


def matrix(lists) -> np.ndarray:
    """An Arrow column of lists of one length as rows of int64."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(lists), -1)


def largest(x: np.ndarray) -> int:
    return max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
