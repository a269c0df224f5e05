"""Small shared building blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(frames: list[DataFrame]) -> DataFrame:
    """Combine single-row frames into one wide row without a join.

    The frames are unioned by name (each contributes its own columns, NULL
    elsewhere) and one global aggregation keeps the single non-NULL value of
    every column. One union branch per frame, types preserved.
    """
    names = [c for f in frames for c in f.columns]
    if len(set(names)) != len(names):
        raise ValueError("column names must be unique across frames")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in names])
