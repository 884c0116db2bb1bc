"""Viewer state: running counts, concurrent viewers, newest records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.operators.prefix import running_sum

ORDER = ("ts", "event_id")


def running_count(df: DataFrame, event_type: str, key: str = "video_id",
                  order: Sequence[str] = ORDER) -> DataFrame:
    """Per-record running count of one event type per video (the output of
    a keyed state update per input record).  Output: event_id, key, running."""
    ev = df.where(F.col("event_type") == event_type).select("event_id", key, *[c for c in order if c != "event_id"])
    return running_sum(ev, order, (key,)).select("event_id", key, "running")


def viewer_timeline(df: DataFrame, key: str = "video_id", order: Sequence[str] = ORDER,
                    extra: Sequence[str] = ()) -> DataFrame:
    """Concurrent viewers after each play (+1) / leave (-1) event; ``extra``
    columns of the event stay."""
    ev = df.where(F.col("event_type").isin("play", "leave"))
    delta = F.when(F.col("event_type") == "play", 1).otherwise(-1)
    cols = list(dict.fromkeys(["event_id", key, *order, *extra]))
    return running_sum(ev.select(*cols, delta.alias("_d")), order, (key,), F.col("_d"), "viewers").select(
        "event_id", key, *extra, "viewers"
    )


def viewer_lows(df: DataFrame, key: str = "video_id", order: Sequence[str] = ORDER) -> DataFrame:
    """When logs were out of order: per video the lowest viewer count after
    any play or leave, the first time of it, and the first time the count was
    below zero (null: never).

    A scan over sums and smallest prefixes: the prefix sums are spread over
    range partitions (``viewer_timeline``), the minima are partial aggregates,
    so a hot video is no task of its own.
    """
    line = viewer_timeline(df, key, order, extra=(order[0],))
    return line.groupBy(key).agg(
        F.min("viewers").alias("lowest"), F.min(F.struct("viewers", order[0]))[order[0]].alias("lowest_at"),
        F.min(F.when(F.col("viewers") < 0, F.col(order[0]))).alias("negative_at"))


def concurrent_views(df: DataFrame, key: str = "video_id") -> DataFrame:
    """plays - leaves for every video with at least one play.

    A negative value means leave records arrived before their plays
    (out-of-order logs) and is flagged rather than hidden.
    """
    t = F.col("event_type")
    agg = df.where(t.isin("play", "leave")).groupBy(key).agg(
        F.count_if(t == "play").alias("plays"), F.count_if(t == "leave").alias("leaves")
    )
    return with_views(agg.where(F.col("plays") >= 1), key)


def with_views(totals: DataFrame, key: str = "video_id") -> DataFrame:
    views = F.col("plays") - F.col("leaves")
    return totals.select(key, "plays", "leaves", views.alias("views"), (views < 0).alias("out_of_order"))


def concurrent_from_totals(plays: DataFrame, leaves: DataFrame, key: str = "video_id") -> DataFrame:
    """Same answer from two serving snapshots (key, n): plays left-join
    leaves, missing leaves = 0."""
    p = plays.select(key, F.col("n").alias("plays"))
    lv = leaves.select(key, F.col("n").alias("leaves"))
    j = p.join(lv, key, "left").select(key, "plays", F.coalesce("leaves", F.lit(0)).cast("bigint").alias("leaves"))
    return with_views(j, key)


def latest_record(df: DataFrame, event_type: str, fields: Sequence[str] = ("ts", "user_id", "latitude", "longitude"),
                  key: str = "video_id", order: Sequence[str] = ORDER) -> DataFrame:
    """Newest record of one type per video by (ts, event_id).

    ``max`` of a struct whose leading fields are the order keys: a partial
    (map-side) aggregate, so a hot video never lands whole in one task.
    """
    extra = [f for f in fields if f not in order]
    rec = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in extra])
    g = df.where(F.col("event_type") == event_type).groupBy(key).agg(F.max(rec).alias("r"))
    return g.select(key, *[F.col(f"r.{c}").alias(c) for c in fields])


def unlocated_videos(df: DataFrame, key: str = "video_id", as_of: Column | None = None) -> DataFrame:
    """Videos that were played while no start record (location) was known.

    For every video: its first play and first start.  Listed when the first
    play comes before the first start, or there is no start at all; with
    ``as_of`` only events before that time count.  This is the anti join
    "plays without a start" evaluated at every point in time at once.
    """
    t = F.col("event_type")
    src = df if as_of is None else df.where(F.col("ts") < as_of)
    g = src.where(t.isin("play", "start_video")).groupBy(key).agg(
        F.min(F.when(t == "play", F.col("ts"))).alias("first_play"),
        F.min(F.when(t == "start_video", F.col("ts"))).alias("first_start"),
    )
    return g.where(
        F.col("first_play").isNotNull()
        & (F.col("first_start").isNull() | (F.col("first_start") > F.col("first_play")))
    )


def plays_without_start(plays: DataFrame, starts: DataFrame, key: str = "video_id") -> DataFrame:
    """Serving-table form: played video keys with no start row (anti join)."""
    return plays.select(key).join(starts.select(key), key, "left_anti")
