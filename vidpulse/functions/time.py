"""Zone-less event times <-> instants, independent of the session zone.

Event times are stored zone-less (``timestamp_ntz``, read as UTC wall
time).  Watermarks need a zoned ``timestamp``; a plain cast would read the
wall time in the session zone, shifting windows whenever the session is not
UTC.  These conversions go through epoch microseconds instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(ts: Column) -> Column:
    """Zone-less time read as UTC -> ``timestamp`` (instant)."""
    micros = (ts - epoch_ntz()).cast("interval second").cast("decimal(20,6)") * 1_000_000
    return F.timestamp_micros(micros.cast("bigint"))


def instant_to_ntz(ts: Column) -> Column:
    """``timestamp`` (instant) -> zone-less UTC wall time."""
    return epoch_ntz() + F.make_dt_interval(secs=(F.unix_micros(ts) / 1_000_000).cast("decimal(18,6)"))


def to_ntz(ts: Column, data_type: T.DataType) -> Column:
    return instant_to_ntz(ts) if isinstance(data_type, T.TimestampType) else ts
