"""Publish guards and initial state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_items(arr: Column, min_items: int = 1) -> Column:
    """True when an array column holds at least ``min_items`` elements
    (publish only non-empty lists)."""
    return F.size(arr) >= min_items


def add_initial_state(current: DataFrame, seed: DataFrame, key: str, value_cols: Sequence[str]) -> DataFrame:
    """Counts that continue from a seed snapshot: per key, seed + current
    (missing side = 0).  A grouped sum over the union, no join."""
    cols = list(value_cols)
    s = seed.select(key, *[F.col(c).cast("bigint").alias(c) for c in cols])
    c = current.select(key, *[F.col(c).cast("bigint").alias(c) for c in cols])
    return s.unionByName(c).groupBy(key).agg(*[F.sum(x).cast("bigint").alias(x) for x in cols])
