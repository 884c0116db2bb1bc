"""Deduplication, geo cells and global event order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.operators.counts import window_start_col
from vidpulse.operators.prefix import running_sum


def delivery_keys(df: DataFrame) -> list[str]:
    """What makes two rows the same delivery: the place in the log where the
    rows carry it, else all fields."""
    place = ["topic", "partition", "offset"]
    return place if set(place) <= set(df.columns) else df.columns


def dedup_events(df: DataFrame, keys: Sequence[str] | None = None, watermark: str | None = None,
                 ts: str = "ts") -> DataFrame:
    """Drop re-delivered copies (at-least-once input); ``keys`` default to
    ``delivery_keys``.  No hash stands for the fields: at scale a 64-bit one
    would merge different events.

    Batch: ``dropDuplicates`` (an aggregate with a map-side step, so many
    copies of one event collapse before the shuffle).  Stream: state kept
    only within the watermark delay.
    """
    keys = list(keys or delivery_keys(df))
    if df.isStreaming and watermark:
        return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def delivery_digest(df: DataFrame, keys: Sequence[str] | None = None) -> Column:
    """SHA-256 (binary) of the fields that make two rows the same delivery:
    each as its length and text, or a mark for null, so no two lists of values
    run together."""
    def field(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[field(k) for k in (keys or delivery_keys(df))]), 256))


def dedup_forever(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Drop re-delivered copies however late they come.

    On a stream the digests of all deliveries stay in the state store, 32
    bytes a delivery, split over the state partitions by digest and committed
    with each micro-batch; with RocksDB (``session.build_session``) they lie in
    sorted files with a Bloom filter each, so a new delivery is told by memory
    and an old one by one read, and memory does not grow with the deliveries.
    No watermark: nothing is forgotten, and nothing is late.
    """
    return df.withColumn("_digest", delivery_digest(df, keys)).dropDuplicates(["_digest"]).drop("_digest")


def geo_cells(df: DataFrame, length: str, cell_degrees: float = 2.0,
              types: Sequence[str] = ("play", "like"), ts: str = "ts") -> DataFrame:
    """Plays and likes per grid cell and window (range queries on area)."""
    ev = df.where(F.col("event_type").isin(list(types)))
    cell_lat = F.floor(F.col("latitude") / cell_degrees).cast("bigint")
    cell_lon = F.floor(F.col("longitude") / cell_degrees).cast("bigint")
    g = ev.groupBy(F.window(ts, length).alias("w"), cell_lat.alias("cell_lat"), cell_lon.alias("cell_lon")).agg(
        *[F.count_if(F.col("event_type") == t).alias(f"{t}s") for t in types]
    )
    return g.select("cell_lat", "cell_lon", window_start_col(df, F.col("w.start"), ts).alias("window_start"),
                    *[f"{t}s" for t in types])


def events_sorted(df: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """1-based global position in (ts, event_id) order.

    A window without PARTITION BY would run in one task; the range-partitioned
    prefix sum keeps it parallel.
    """
    return running_sum(df.select("event_id", *[c for c in order if c != "event_id"]), order, (), None, "pos")
