"""Windowed and running counts per video (batch and streaming).

All counts are hash aggregates with a map-side partial step, so a video that
holds a large share of the events is reduced to one row per map task before
the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.functions.time import to_ntz
from vidpulse.session import checkpointed

REACTION_TYPES = ["like", "dislike", "play", "leave"]


def _window(ts: str, length: str, slide: str | None) -> Column:
    return F.window(ts, length, slide) if slide else F.window(ts, length)


def window_start_col(df: DataFrame, start: Column, ts: str = "ts") -> Column:
    """Window starts keep the zone-less type of the source ``ts``.

    Streams carry a zoned ``timestamp`` (needed for watermarks); the start
    is converted back (zone-independently) so batch and stream outputs have
    one schema and one value.
    """
    return to_ntz(start, df.schema[ts].dataType)


def window_counts(df: DataFrame, length: str, slide: str | None = None,
                  keys: Sequence[str] = ("video_id",), ts: str = "ts",
                  value: Column | None = None, out: str = "n") -> DataFrame:
    """Events per key per tumbling (``slide=None``) or sliding window.

    ``value`` replaces the plain count by a sum (e.g. +1/-1 for viewers).
    Output: keys, window_start, ``out``.  Sliding windows of a table are
    summed from panes (``sliding_from_panes``), so a row is shuffled once, not
    once per window; a stream (which emits windows as they change) and lengths
    that are no multiple of the slide copy the row to each of its windows.
    """
    if slide and not df.isStreaming and _multiple(length, slide):
        return sliding_from_panes(pane_counts(df, slide, keys, ts, value), length, slide, keys).withColumnRenamed("n", out)
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    g = df.groupBy(_window(ts, length, slide).alias("w"), *keys).agg(agg.cast("bigint").alias(out))
    return g.select(*keys, window_start_col(df, F.col("w.start"), ts).alias("window_start"), out)


def _multiple(length: str, slide: str) -> bool:
    return pd.Timedelta(length) % pd.Timedelta(slide) == pd.Timedelta(0)


def pane_counts(df: DataFrame, slide: str, keys: Sequence[str] = ("video_id",), ts: str = "ts", value: Column | None = None) -> DataFrame:
    """Tumbling counts per ``slide``: keys, pane_start, n (rows, or the sum of
    ``value``) and rows.  Works on a stream (update mode): one state row per
    pane, whatever the number of windows over it."""
    n = F.count(F.lit(1)) if value is None else F.sum(value)
    g = df.groupBy(F.window(ts, slide).alias("w"), *keys).agg(n.cast("bigint").alias("n"), F.count(F.lit(1)).alias("rows"))
    return g.select(*keys, window_start_col(df, F.col("w.start"), ts).alias("pane_start"), "n", "rows")


def sliding_from_panes(panes: DataFrame, length: str, slide: str, keys: Sequence[str] = ("video_id",)) -> DataFrame:
    """Sliding window sums from panes: a running sum to which each pane is
    added at the first window that covers it and taken off (the inverse) after
    the last.

    Between two such points the sum does not change, so it is worked out once
    per point and spread over the windows up to the next.  Output: keys,
    window_start, n for every window that covers a row.  A key has at most two
    points per pane, however many rows it has.
    """
    keys, step = list(keys), F.expr(f"INTERVAL {slide}")
    enter, leave = F.col("pane_start") - (F.expr(f"INTERVAL {length}") - step), F.col("pane_start") + step
    points = panes.select(*keys, F.explode(F.array(
        F.struct(enter.alias("start"), F.col("n").alias("n"), F.col("rows").alias("rows")),
        F.struct(leave.alias("start"), (-F.col("n")).alias("n"), (-F.col("rows")).alias("rows")))).alias("p"))
    changes = points.groupBy(*keys, F.col("p.start").alias("start")).agg(F.sum("p.n").alias("n"), F.sum("p.rows").alias("rows"))
    order = Window.partitionBy(*keys).orderBy("start")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    held = changes.select(*keys, "start", F.lead("start").over(order).alias("next"), F.sum("n").over(upto).alias("n"), F.sum("rows").over(upto).alias("rows"))
    return held.where(F.col("rows") > 0).select(
        *keys, F.explode(F.sequence("start", F.col("next") - step, step)).alias("window_start"), F.col("n").cast("bigint").alias("n"))


def typed_window_counts(df: DataFrame, event_type: str, length: str, slide: str | None = None,
                        key: str = "video_id", ts: str = "ts") -> DataFrame:
    """Tumbling/sliding count of one event type (likes, dislikes, ...)."""
    return window_counts(df.where(F.col("event_type") == event_type), length, slide, (key,), ts)


def sliding_counts(df: DataFrame, length: str, slide: str, types: Sequence[str] = REACTION_TYPES,
                   key: str = "video_id", ts: str = "ts") -> DataFrame:
    """Per (video, event type) sliding-window counts; the incremental
    add/inverse reduce of a DStream becomes one grouped count over every
    window a row falls in."""
    return window_counts(df.where(F.col("event_type").isin(list(types))), length, slide,
                         (key, "event_type"), ts)


#: Windows of a gap that are generated by one array.
GAP_BLOCK = 256


def fill_zero_windows(counts: DataFrame, slide: str, keys: Sequence[str] = ("video_id", "event_type"),
                      ends: DataFrame | None = None) -> DataFrame:
    """Keep windows whose count fell to zero (batch only).

    Each key gets every window start on the ``slide`` grid from its first
    window to its last: the newest window start of the whole input, or, with
    ``ends`` (first key, end_start), the start given for that key (a video's
    end record).  Starts with no rows get 0.  The counts are checkpointed
    (the input is read once); ``lead`` gives the next non-empty window, and
    the gap is generated in blocks of ``GAP_BLOCK`` windows, so no array
    grows with a key's span and no generated row is shuffled.
    """
    counts = checkpointed(counts.select(*keys, "window_start", "n"))
    nxt = F.lead("window_start").over(Window.partitionBy(*keys).orderBy("window_start"))
    step = F.expr(f"INTERVAL {slide}")
    if ends is None:
        last = counts.select(F.max("window_start")).scalar()
    else:
        counts = counts.join(ends.select(keys[0], "end_start"), keys[0], "left")
        last = F.greatest("window_start", F.coalesce("end_start", "window_start"))
    gaps = counts.select(*keys, "n", F.col("window_start").alias("_start"), F.coalesce(nxt, last + step).alias("_next"))
    seconds = lambda a, b: F.timestamp_diff("SECOND", a, b)
    many = (seconds(F.col("_start"), F.col("_next")) / seconds(F.col("_start"), F.col("_start") + step)).cast("int")
    blocks = gaps.select(*keys, "n", "_start", many.alias("_many")).select(
        "*", F.explode(F.sequence(F.lit(0), F.floor((F.col("_many") - 1) / GAP_BLOCK).cast("int"))).alias("_block"))
    first = F.col("_block") * GAP_BLOCK
    rows = blocks.select(*keys, "n", "_start", F.explode(
        F.sequence(first, F.least(F.col("_many"), first + GAP_BLOCK) - 1)).alias("_i"))
    return rows.select(*keys, (F.col("_start") + F.col("_i") * step).alias("window_start"),
                       F.when(F.col("_i") == 0, F.col("n")).otherwise(0).cast("bigint").alias("n"))


def net_viewer_change(df: DataFrame, length: str, slide: str | None = None,
                      key: str = "video_id", ts: str = "ts") -> DataFrame:
    """plays - leaves per window; a window exists if it has either."""
    pl = df.where(F.col("event_type").isin("play", "leave"))
    delta = F.when(F.col("event_type") == "play", 1).otherwise(-1)
    return window_counts(pl, length, slide, (key,), ts, value=delta, out="net")


def running_totals(df: DataFrame, key: str = "video_id") -> DataFrame:
    """Cumulative likes, dislikes, plays, leaves and comments per video.

    On a stream this is the stateful count (update mode), replacing keyed
    ``updateStateByKey`` / ``mapWithState`` state code.
    """
    t = F.col("event_type")
    return df.groupBy(key).agg(
        F.count_if(t == "like").alias("likes"),
        F.count_if(t == "dislike").alias("dislikes"),
        F.count_if(t == "play").alias("plays"),
        F.count_if(t == "leave").alias("leaves"),
        F.count_if(t == "comment").alias("comments"),
    )


def latest_window(counts: DataFrame, key: str = "video_id") -> DataFrame:
    """Newest non-empty window per key: the value a last-write-wins key store
    holds after overwriting each window's counts (quiet videos keep their
    last count)."""
    return counts.groupBy(key).agg(
        F.max("window_start").alias("window_start"),
        F.max_by("n", "window_start").alias("n"),
    )


def latest_window_as_of(counts: DataFrame, as_of_start: Column, key: str = "video_id") -> DataFrame:
    """Variant: the count of the window starting at ``as_of_start`` (0 when
    the video had no events in it), in one aggregate over the counts."""
    in_window = F.when(F.col("window_start") == as_of_start, F.col("n"))
    return counts.groupBy(key).agg(F.coalesce(F.sum(in_window), F.lit(0)).cast("bigint").alias("n"))
