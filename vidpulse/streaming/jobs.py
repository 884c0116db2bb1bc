"""Structured Streaming jobs.

* reaction counts: event-time tumbling/sliding windows with a watermark,
  update mode, keyed upsert into ``recent_<type>``;
* totals: counts per video and batch, added up in ``totals`` (from an initial
  state if there is one); ``totals_stream_df`` is the form with keyed state;
* comment statistics: per micro-batch (foreachBatch) the sentence sentiment
  histogram, word, token and sentence counts, written as additive partial
  tables (summed on read); load is shed only where a capacity is set;
* ``start_all``: several queries in one application, ``awaitAnyTermination``.

Streams need a zoned ``timestamp`` for watermarks; zone-less times are read
as UTC (independent of the session zone) and window starts are converted
back on output.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidpulse.functions.text import token_array
from vidpulse.functions.time import ntz_to_instant

from vidpulse.operators.routing import with_comments
from vidpulse.operators.text import StopWords
from vidpulse.operators import counts, misc, sentiment, text, viewers
from vidpulse.plans.comment_stats import PARTIAL_TABLES, comment_partials, partials_from_sentence_counts
from vidpulse.session import checkpointed, scratch_path, state_partitions
from vidpulse.sources.envelope import bad_record_count
from vidpulse.sources.events import read_table_stream
from vidpulse.sources.fixtures import conversations_as_comments, derive_lexicon, events_as_video_events, lv_comments, lv_events
from vidpulse.streaming.levels import LevelledTable
from vidpulse.streaming.sinks import UpsertTable, upsert_sink

WATERMARK = "1 hour"


def with_event_time(df: DataFrame, watermark: str = WATERMARK, ts: str = "ts") -> DataFrame:
    """Zoned event time (UTC reading of a zone-less ``ts``) + watermark."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        df = df.withColumn(ts, ntz_to_instant(F.col(ts)))
    return df.withWatermark(ts, watermark)


def reaction_counts_stream(events: DataFrame, event_type: str, length: str, slide: str | None = None,
                           watermark: str = WATERMARK) -> DataFrame:
    return counts.typed_window_counts(with_event_time(events, watermark), event_type, length, slide)


def sliding_counts_stream(events: DataFrame, length: str, slide: str, watermark: str = WATERMARK) -> DataFrame:
    """Per (video, type) sliding counts on event time; update mode emits
    every window a batch touched, state of closed windows is evicted."""
    return counts.sliding_counts(with_event_time(events, watermark), length, slide)


def totals_stream_df(events: DataFrame) -> DataFrame:
    """Exact cumulative totals per video; state holds one row per video
    ever seen (bounded by the number of videos, kept in RocksDB)."""
    return counts.running_totals(events)


TOTAL_COLUMNS = ["likes", "dislikes", "plays", "leaves", "comments"]
TOTAL_TYPES = ["like", "dislike", "play", "leave", "comment"]


def bucketed_totals_stream_df(events: DataFrame, bucket: str = "1 day", watermark: str = WATERMARK) -> DataFrame:
    """Totals per (video, event-time bucket): state exists only for buckets
    the watermark has not passed, so it stays bounded by the live videos of
    the open buckets.  Totals = sum over buckets (``AdditiveTable`` read or
    ``totals_from_buckets``).  Trade-off: events later than the watermark
    are dropped, where ``totals_stream_df`` counts everything."""
    ev = with_event_time(events, watermark)
    t = F.col("event_type")
    g = ev.groupBy(F.window("ts", bucket).alias("w"), "video_id").agg(
        *[F.count_if(t == kind).alias(col) for kind, col in zip(TOTAL_TYPES, TOTAL_COLUMNS)]
    )
    return g.select("video_id", counts.window_start_col(ev, F.col("w.start")).alias("window_start"), *TOTAL_COLUMNS)


def totals_from_buckets(buckets: DataFrame, key: str = "video_id") -> DataFrame:
    return buckets.groupBy(key).agg(*[F.sum(c).cast("bigint").alias(c) for c in TOTAL_COLUMNS])


def totals_sink(table: UpsertTable, seed: DataFrame | None = None, key: str = "video_id"):
    """foreachBatch body for totals: each batch adds its own counts to a table
    of sums, so nothing but the batch is read.  ``seed`` (totals per video to
    go on from) is the table's first batch, written when the table is new and
    never read by the stream again."""
    if seed is not None:
        table.write_batch(seed.select(key, *[F.col(c).cast("bigint").alias(c) for c in TOTAL_COLUMNS]), -1)

    def run(batch: DataFrame, batch_id: int) -> None:
        table(counts.running_totals(batch, key), batch_id)

    return run


def start_bad_record_count(raw: DataFrame, root: str, trigger: dict | None = None, envelope: bool = True):
    """Malformed records per source as a serving table (``bad_records``):
    the readers leave them out, here they are counted."""
    table = LevelledTable(f"{root}/bad_records", ["source"], sums=["n"])

    def run(batch: DataFrame, batch_id: int) -> None:
        table(bad_record_count(batch, envelope=envelope), batch_id)

    q = raw.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/_checkpoints/bad_records")
    return q.trigger(**(trigger or {"processingTime": "60 seconds"})).start(), table


def comment_tables(root: str, names: Sequence[str] = tuple(PARTIAL_TABLES)) -> dict[str, UpsertTable]:
    """Tables of the additive comment counts (summed when merged and read)."""
    return {name: LevelledTable(f"{root}/{name}", keys, sums=sums) for name, (keys, sums) in PARTIAL_TABLES.items() if name in names}


def comment_batch(tables: dict[str, UpsertTable], lexicon: DataFrame | None, stop_words: StopWords,
                  capacity: int | None = None, draw: str = "hash", scorer=None):
    """foreachBatch body for comments.  Outputs are additive partial counts,
    so an event-time window split over two micro-batches is summed on read
    instead of overwritten.  With a ``capacity`` the sample needs the total
    word count before any sentence is dropped, which the micro-batch has."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by several outputs; executor storage
        try:
            for name, out in comment_partials(batch, lexicon, stop_words, capacity, draw=draw, scorer=scorer).items():
                if name in tables:
                    tables[name](out, batch_id)
        finally:
            batch.unpersist()

    return run


def start_comment_stats(comments: DataFrame, root: str, lexicon: DataFrame | None, stop_words: StopWords,
                        capacity: int | None = None, trigger: dict | None = None, outputs=tuple(PARTIAL_TABLES),
                        scorer=None):
    """Comment statistics per micro-batch.  The static lexicon is
    checkpointed once, so micro-batches do not recompute it."""
    tables = comment_tables(root, outputs)
    lexicon = lexicon if lexicon is None else checkpointed(lexicon)
    q = (
        comments.writeStream.foreachBatch(comment_batch(tables, lexicon, stop_words, capacity, scorer=scorer))
        .option("checkpointLocation", f"{root}/_checkpoints/comments")
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )
    return q, tables


def closed_window_sentences(comments: DataFrame, length: str = text.COMMENT_WINDOW,
                            watermark: str = "10 seconds") -> DataFrame:
    """Sentence counts per (video, comment window, sentence), emitted in
    append mode: a window appears once, complete, after the watermark has
    passed its end.  Hot sentences are pre-aggregated in state."""
    ev = with_event_time(comments, watermark)
    sentences = text.comment_sentences(ev)
    g = sentences.groupBy("video_id", F.window("ts", length).alias("w"), "sentence").agg(
        F.count(F.lit(1)).alias("n"))
    return g.select("video_id", counts.window_start_col(ev, F.col("w.start")).alias("window_start"), "sentence", "n")


def start_comment_stats_exact(comments: DataFrame, root: str, lexicon: DataFrame | None, stop_words: StopWords,
                              capacity: int | None = None, watermark: str = "10 seconds",
                              trigger: dict | None = None, scorer=None):
    """Comment statistics over complete event-time windows: with a
    ``capacity`` every window is sampled against its whole word count (exact
    window-global shedding), with a latency of one window plus the watermark
    delay."""
    tables = comment_tables(root)
    lexicon = lexicon if lexicon is None else checkpointed(lexicon)

    def run(per: DataFrame, batch_id: int) -> None:
        per = per.persist()
        try:
            for name, out in partials_from_sentence_counts(per, lexicon, stop_words, capacity, scorer=scorer).items():
                tables[name](out, batch_id)
        finally:
            per.unpersist()

    q = (
        closed_window_sentences(comments, watermark=watermark).writeStream.outputMode("append")
        .foreachBatch(run).option("checkpointLocation", f"{root}/_checkpoints/comments_exact")
        .trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    )
    return q, tables


def read_comment_views(spark: SparkSession, tables: dict[str, UpsertTable], k: int = 5,
                       since: str | None = None, only: DataFrame | None = None) -> dict[str, DataFrame]:
    """Serving views over the additive comment tables: mean sentiment, top
    words, token statistics and token lists per (video, window).  ``since``
    and ``only`` ((video_id, window_start) rows) narrow what is read and
    ranked."""
    def read(name: str) -> DataFrame:
        return tables[name].read(spark, since, only)

    out = {}
    if "comment_sentiment" in tables:
        out["comment_sentiment"] = sentiment.mean_sentiment(read("comment_sentiment"))
    if "comment_words" in tables:
        out["comment_words"] = text.top_words(read("comment_words"), k)
    if "comment_tokens" in tables:
        out["comment_tokens"] = read("comment_tokens")
    if "comment_sentences" in tables:
        out["sentence_tokens"] = read("comment_sentences").withColumn("tokens", token_array(F.col("sentence")))
    return out


SERVING_KEYS = {
    "recent_likes": ["video_id", "window_start"],
    "recent_dislikes": ["video_id", "window_start"],
    "recent_comments": ["video_id", "window_start"],
    "totals": ["video_id"],
    "video_start": ["video_id"],
    "video_end": ["video_id"],
}


def serving_tables(root: str) -> dict[str, UpsertTable]:
    """Handles of every serving table under ``root`` (as ``start_all``
    writes them), for readers in another process.  They are levelled: the
    streams merge their batches as they go on."""
    sums = {"totals": TOTAL_COLUMNS}
    return {**{name: LevelledTable(f"{root}/{name}", keys, sums=sums.get(name)) for name, keys in SERVING_KEYS.items()}, **comment_tables(root)}


EventSource = DataFrame | Callable[[list[str]], DataFrame]


def start_all(events: EventSource, comments: DataFrame, root: str, lexicon: DataFrame | None, stop_words: StopWords,
              reaction_window: str = "10 seconds", trigger: dict | None = None, capacity: int | None = None,
              exact_comment_windows: bool = False, totals_seed: DataFrame | None = None, scorer=None):
    """All serving tables from one application (one query per table).

    ``events``: one frame, or a function that gives the events of the types
    it is asked for, so each output subscribes to its own topics only.
    ``capacity``: words per comment window beyond which sentences are shed
    (default: none are); ``exact_comment_windows``: against each closed
    window's whole load instead of per micro-batch.  ``totals_seed``: totals
    per video that the counts go on from."""
    def of(*types: str) -> DataFrame:
        return events(list(types)) if callable(events) else events

    tables = serving_tables(root)
    outputs = {
        "recent_likes": reaction_counts_stream(of("like"), "like", reaction_window),
        "recent_dislikes": reaction_counts_stream(of("dislike"), "dislike", reaction_window),
        "recent_comments": counts.window_counts(with_event_time(comments), text.COMMENT_WINDOW, "20 seconds"),
        "totals": of(*TOTAL_TYPES),
        "video_start": viewers.latest_record(of("start_video"), "start_video"),
        "video_end": viewers.latest_record(of("end_video"), "end_video"),
    }
    sinks = {**tables, "totals": totals_sink(tables["totals"], totals_seed)}
    queries = [upsert_sink(df, sinks[name], f"{root}/_checkpoints/{name}", trigger, name)
               for name, df in outputs.items()]
    start = start_comment_stats_exact if exact_comment_windows else start_comment_stats
    q, ct = start(comments, root, lexicon, stop_words, capacity, trigger=trigger, scorer=scorer)
    queries.append(q)
    tables.update(ct)  # the comment jobs' own handles (same paths and keys)
    return queries, tables


def await_any(spark: SparkSession, timeout: float | None = None) -> bool:
    """Block until one of the running queries stops (or the timeout)."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()


def late_rows(query) -> int:
    """Rows that the query's watermark dropped so far."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def _finish(query) -> None:
    """Wait for a bounded run; late rows would be missing from its result."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if n := late_rows(query):
        raise RuntimeError(f"{n} rows were dropped as late: their answer is incomplete")


def _run_once(df: DataFrame, table: UpsertTable, checkpoint: str) -> None:
    """Run a stream over the available input (availableNow) into ``table``."""
    with state_partitions(df.sparkSession):
        _finish(upsert_sink(df, table, checkpoint, {"availableNow": True}))


def _events_stream(spark: SparkSession, sf_dir: str, types: list[str] | None = None) -> DataFrame:
    return events_as_video_events(read_table_stream(spark, sf_dir, "events"), types)


def run_reaction_counts_once(spark: SparkSession, sf_dir: str, event_type: str, length: str) -> DataFrame:
    """Stream the events table once (availableNow) into a serving table and
    read the newest value per (video, window)."""
    root = scratch_path(spark, f"stream-{event_type}")
    table = UpsertTable(os.path.join(root, "table"), ["video_id", "window_start"])
    events = _events_stream(spark, sf_dir, [event_type])
    _run_once(reaction_counts_stream(events, event_type, length), table, os.path.join(root, "checkpoint"))
    return table.read(spark).select("video_id", "window_start", "n")


def pane_counts_stream(events: DataFrame, slide: str, types: Sequence[str] = counts.REACTION_TYPES, watermark: str = WATERMARK) -> DataFrame:
    """Pane counts per (video, type): one state row per pane.  The sliding
    windows are summed from the serving table of panes when it is read."""
    ev = with_event_time(events, watermark).where(F.col("event_type").isin(list(types)))
    return counts.pane_counts(ev, slide, ("video_id", "event_type"))


def run_sliding_counts_once(spark: SparkSession, sf_dir: str, length: str, slide: str, zeros: bool = False) -> DataFrame:
    """Sliding counts over the panes that a stream keeps; with ``zeros`` the
    windows whose count fell to zero stay."""
    root = scratch_path(spark, "stream-sliding")
    events = _events_stream(spark, sf_dir, list(counts.REACTION_TYPES))
    keys = ["video_id", "event_type"]
    table = LevelledTable(os.path.join(root, "table"), [*keys, "pane_start"], date_col="pane_start")
    _run_once(pane_counts_stream(events, slide), table, os.path.join(root, "checkpoint"))
    sliding = counts.sliding_from_panes(table.read(spark), length, slide, keys)
    return (counts.fill_zero_windows(sliding, slide) if zeros else sliding).select(*keys, "window_start", "n")


def run_bucketed_totals_once(spark: SparkSession, sf_dir: str, bucket: str = "1 day") -> DataFrame:
    """Bucketed totals through the stream; the upsert table keeps the newest
    count per (video, bucket) and the read sums the buckets."""
    root = scratch_path(spark, "stream-bucketed-totals")
    table = UpsertTable(os.path.join(root, "table"), ["video_id", "window_start"])
    _run_once(bucketed_totals_stream_df(_all_events_stream(spark, sf_dir), bucket), table, os.path.join(root, "checkpoint"))
    return totals_from_buckets(table.read(spark)).select("video_id", *TOTAL_COLUMNS)


def _all_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and comments as one stream."""
    comments = conversations_as_comments(read_table_stream(spark, sf_dir, "conversations"))
    return with_comments(_events_stream(spark, sf_dir), comments)


def run_totals_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream-totals")
    table = UpsertTable(os.path.join(root, "table"), ["video_id"])
    _run_once(totals_stream_df(_all_events_stream(spark, sf_dir)), table, os.path.join(root, "checkpoint"))
    return table.read(spark).select("video_id", *TOTAL_COLUMNS)


def run_comment_sentiment_once(spark: SparkSession, sf_dir: str, capacity: int | None = None) -> DataFrame:
    """Stream the comments once through the foreachBatch statistics and read
    the sentiment serving table."""
    root = scratch_path(spark, "stream-comments")
    comments = conversations_as_comments(read_table_stream(spark, sf_dir, "conversations"))
    with state_partitions(spark):
        q, tables = start_comment_stats(comments, root, derive_lexicon(lv_comments(spark, sf_dir)), None, capacity,
                                        {"availableNow": True}, ("comment_sentiment",))
        _finish(q)
    view = read_comment_views(spark, tables)["comment_sentiment"]
    return view.select("video_id", "window_start", "score", "n")


def in_batches(df: DataFrame, path: str, batches: int) -> DataFrame:
    """``df`` written as ``batches`` files and streamed back one file a micro-batch."""
    df.repartition(batches).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run_totals_levelled_once(spark: SparkSession, sf_dir: str, batches: int = 8, merge_every: int = 3) -> DataFrame:
    """Totals over several micro-batches into a levelled table that merges
    while the stream runs."""
    root = scratch_path(spark, "stream-levels")
    events = in_batches(with_comments(lv_events(spark, sf_dir), lv_comments(spark, sf_dir)), f"{root}/input", batches)
    table = LevelledTable(f"{root}/table", ["video_id"], merge_every=merge_every)
    _run_once(totals_stream_df(events), table, f"{root}/checkpoint")
    return table.read(spark).select("video_id", *TOTAL_COLUMNS)


def run_word_counts_levelled_once(spark: SparkSession, sf_dir: str, stop_words: StopWords, batches: int = 5, merge_every: int = 2) -> DataFrame:
    """Word counts of comment windows that are spread over micro-batches:
    partial counts, summed as the levels merge and when read."""
    root = scratch_path(spark, "stream-words")
    comments = in_batches(lv_comments(spark, sf_dir), f"{root}/input", batches)
    table = LevelledTable(f"{root}/table", ["video_id", "window_start", "word"], sums=["n"], merge_every=merge_every)

    def run(batch: DataFrame, batch_id: int) -> None:
        table(text.word_counts(batch, stop_words), batch_id)

    _finish(comments.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return table.read(spark).select("video_id", "window_start", "word", "n")


def run_dedup_once(spark: SparkSession, sf_dir: str, batches: int = 4) -> DataFrame:
    """Events per type, every event delivered twice in any of the
    micro-batches, counted once."""
    root = scratch_path(spark, "stream-dedup")
    events = lv_events(spark, sf_dir)
    unique = misc.dedup_forever(in_batches(events.unionByName(events), f"{root}/input", batches))
    table = LevelledTable(f"{root}/table", ["event_type"], sums=["n"], merge_every=3)

    def run(batch: DataFrame, batch_id: int) -> None:
        table(batch.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), batch_id)

    with state_partitions(spark):
        _finish(unique.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return table.read(spark).select("event_type", "n")
