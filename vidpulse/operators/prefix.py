"""Skew-safe running sums (distributed prefix sum).

``SUM(w) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING)`` sends
every row of a key to one task; one viral video (or the global order, which
has a single "key") would then sit in one task.  Instead:

1. range-partition on (key, order...) - the sampled bounds include the
   unique tie-breaker, so a hot key is spread over many partitions;
2. running sum inside each (partition, key) slice;
3. per (partition, key) totals -> exclusive prefix over partitions per key.
   Ranges are contiguous, so only the first key of a partition can continue
   from an earlier partition: at most ``n - 1`` offset rows.  That bound is
   what makes the broadcast of the offsets safe;
4. add the offset.

The partition ids are computed once and checkpointed with the rows: the
totals and the rows read the same stored ids, whatever other columns the
frame carries.  Two separate range exchanges could be sampled differently
and disagree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.session import checkpointed

_PART = "_rp"


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_sum(df: DataFrame, order: Sequence[str], keys: Sequence[str] = (),
                weight: Column | None = None, out: str = "running",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = running sum of ``weight`` (default 1) per ``keys`` in
    ``order`` (which must be a total order, e.g. end with a unique id)."""
    keys, order = list(keys), list(order)
    n = _partitions(df, num_partitions)
    w = (weight if weight is not None else F.lit(1)).cast("bigint")
    ranged = (
        df.withColumn("_w", w)
        .repartitionByRange(n, *keys, *order)
        .withColumn(_PART, F.spark_partition_id())
    )
    ranged = checkpointed(ranged)
    local_w = Window.partitionBy(_PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumn("_local", F.sum("_w").over(local_w))

    slices = ranged.groupBy(_PART, *keys).agg(F.sum("_w").alias("_slice"))
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slices.withColumn("_off", F.sum("_slice").over(before))
        .where(F.col("_off").isNotNull())
        .select(_PART, *keys, "_off")
    )
    joined = local.join(F.broadcast(offsets), [_PART, *keys], "left")
    return joined.withColumn(out, (F.col("_local") + F.coalesce("_off", F.lit(0))).cast("bigint")).drop(
        _PART, "_w", "_local", "_off"
    )
