"""Uniform draws and keep probabilities for load shedding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def hash_uniform(*cols: Column) -> Column:
    """Deterministic draw in [0, 1): the first 8 hex digits of
    md5(c1 | c2 | ...) read as an integer over 2^32.  Equal inputs get
    equal draws, so results are reproducible and testable."""
    h = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def random_uniform(seed: int | None = None) -> Column:
    return F.rand(seed)


def keep_probability(total: Column, capacity: int) -> Column:
    """capacity / total above capacity, else 1."""
    return F.when(total > capacity, F.lit(float(capacity)) / total).otherwise(F.lit(1.0))
