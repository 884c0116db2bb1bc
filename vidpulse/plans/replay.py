"""Batch replay: rebuild every serving table from the raw archive.

The same operators as the streams, run once over ``read_archive`` output,
written as batch 0 of the serving tables, so ``plans.live`` (and any other
reader of the serving tables) works unchanged on historical data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vidpulse.functions.guards import add_initial_state
from vidpulse.operators.text import COMMENT_WINDOW, StopWords
from vidpulse.operators import counts, viewers
from vidpulse.operators.routing import comments_of
from vidpulse.plans.comment_stats import PARTIAL_TABLES, comment_partials
from vidpulse.sources.events import read_archive
from vidpulse.streaming.jobs import TOTAL_COLUMNS
from vidpulse.streaming.levels import LevelledTable
from vidpulse.streaming.sinks import UpsertTable

REPLAY_BATCH = 0


def serving_tables_of(events: DataFrame, lexicon: DataFrame, stop_words: StopWords,
                      reaction_window: str,
                      capacity: int | None = None, totals_seed: DataFrame | None = None) -> dict[str, tuple[list[str], DataFrame]]:
    """(keys, rows) of every serving table from a batch of events (with
    comment events among them)."""
    out: dict[str, tuple[list[str], DataFrame]] = {}
    for kind in ("like", "dislike"):
        out[f"recent_{kind}s"] = (["video_id", "window_start"], counts.typed_window_counts(events, kind, reaction_window))
    totals = counts.running_totals(events)
    if totals_seed is not None:
        totals = add_initial_state(totals, totals_seed, "video_id", TOTAL_COLUMNS)
    out["totals"] = (["video_id"], totals)
    for kind, name in (("start_video", "video_start"), ("end_video", "video_end")):
        out[name] = (["video_id"], viewers.latest_record(events, kind))
    comments = comments_of(events).select("video_id", "ts", "comment")
    out["recent_comments"] = (["video_id", "window_start"], counts.window_counts(comments, COMMENT_WINDOW, "20 seconds"))
    for name, df in comment_partials(comments, lexicon, stop_words, capacity).items():
        out[name] = (PARTIAL_TABLES[name][0], df)
    return out


def replay_serving_tables(spark: SparkSession, archive: str, root: str, lexicon: DataFrame,
                          stop_words: StopWords,
                          reaction_window: str = "10 seconds", capacity: int | None = None,
                          totals_seed: DataFrame | None = None,
                          first_date: str | None = None, last_date: str | None = None) -> dict[str, UpsertTable]:
    """Recompute the serving tables from the archive (optionally a date
    range, pruned at listing) into ``root``; returns the table handles.
    Every sentence is scored unless a ``capacity`` is given."""
    events = read_archive(spark, archive, first_date=first_date, last_date=last_date)
    tables: dict[str, UpsertTable] = {}
    for name, (keys, df) in serving_tables_of(events, lexicon, stop_words, reaction_window, capacity, totals_seed).items():
        path = f"{root}/{name}"
        t = LevelledTable(path, keys, sums=PARTIAL_TABLES[name][1] if name in PARTIAL_TABLES else None)
        t.write_batch(df, REPLAY_BATCH)
        tables[name] = t
    return tables
