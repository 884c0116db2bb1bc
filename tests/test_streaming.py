"""Stream = batch, restart from checkpoint, late data, JSON line source."""

import json
import os

from pyspark.sql import functions as F

from core_paths import SF_SMALL
from vidpulse.operators import counts
from vidpulse.sources.events import read_event_lines
from vidpulse.sources.fixtures import events_as_video_events
from vidpulse.streaming.jobs import reaction_counts_stream, start_comment_stats, totals_stream_df
from vidpulse.streaming.sinks import UpsertTable, upsert_sink


def _time_chunks(spark, src_dir, chunks):
    """The events table split into ``chunks`` consecutive time ranges."""
    ev = spark.read.parquet(f"{src_dir}/events.parquet")
    bounds = ev.approxQuantile("event_id", [i / chunks for i in range(1, chunks)], 0.0)
    edges = [-1] + [int(b) for b in bounds] + [10**18]
    return ev.schema, [ev.where((F.col("event_id") > lo) & (F.col("event_id") <= hi)) for lo, hi in zip(edges, edges[1:])]


def _append(chunks, dest):
    for c in chunks:  # one file per chunk, written in time order
        c.coalesce(1).write.mode("append").parquet(dest)


def _stream(spark, path, schema):
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    return events_as_video_events(raw)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_stream_equals_batch_with_restart(spark, scratch):
    src = os.path.join(scratch, "src")
    schema, chunks = _time_chunks(spark, SF_SMALL, 4)
    _append(chunks[:2], src)
    likes = UpsertTable(os.path.join(scratch, "likes"), ["video_id", "window_start"])
    totals = UpsertTable(os.path.join(scratch, "totals"), ["video_id"])
    ck1, ck2 = os.path.join(scratch, "ck1"), os.path.join(scratch, "ck2")
    for run in range(2):  # second run: restart from the checkpoints after later files arrive
        ev = _stream(spark, src, schema)
        q1 = upsert_sink(reaction_counts_stream(ev, "like", "6 hours"), likes, ck1, {"availableNow": True})
        q2 = upsert_sink(totals_stream_df(ev), totals, ck2, {"availableNow": True})
        q1.awaitTermination()
        q2.awaitTermination()
        if run == 0:
            _append(chunks[2:], src)
    batch_ev = events_as_video_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    want_likes = counts.typed_window_counts(batch_ev, "like", "6 hours")
    want_tot = counts.running_totals(batch_ev)
    cols = ["video_id", "window_start", "n"]
    assert _rows(likes.read(spark), cols) == _rows(want_likes, cols)
    tcols = ["video_id", "likes", "dislikes", "plays", "leaves"]
    assert _rows(totals.read(spark), tcols) == _rows(want_tot, tcols)
    # state crossed batches: one batch folder per file
    assert len([d for d in os.listdir(totals.path) if d.startswith("batch=")]) == 4


def _json_file(path, name, events):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for e in events:
            f.write(json.dumps(e) + "\n")


def _ev(t, kind="play", vid=1):
    return {"user_id": 1, "event_type": kind, "timestamp": t, "video_id": vid, "longitude": -90.0, "latitude": 40.0}


def test_late_event_dropped_by_watermark(spark, scratch):
    """Late rows are filtered against the watermark of the previous batch
    (Spark keeps the late-event watermark one batch behind), so the late
    row arrives in the third file."""
    src = os.path.join(scratch, "lines")
    # simulator units of 10 s: 3600 -> 10:00, 3780 -> 10:30, 2880 -> 08:00, 3840 -> 10:40
    files = [("a.json", [_ev(3600), _ev(3601)]), ("b.json", [_ev(3780)]), ("c.json", [_ev(2880), _ev(3840)])]
    t0 = None
    for i, (name, rows) in enumerate(files):
        _json_file(src, name, rows)
        p = os.path.join(src, name)
        t0 = t0 or os.path.getmtime(p)
        os.utime(p, (t0 + 5 * i, t0 + 5 * i))
    stream = read_event_lines(spark, src, streaming=True, max_files_per_trigger=1)
    table = UpsertTable(os.path.join(scratch, "plays"), ["video_id", "window_start"])
    q = upsert_sink(reaction_counts_stream(stream, "play", "10 minutes", watermark="1 hour"), table,
                    os.path.join(scratch, "ck"), {"availableNow": True})
    q.awaitTermination()
    got = {str(r.window_start): r.n for r in table.read(spark).collect()}
    assert got == {"1970-01-01 10:00:00": 2, "1970-01-01 10:30:00": 1, "1970-01-01 10:40:00": 1}
    dropped = sum(s.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1
    batch = read_event_lines(spark, src)
    assert batch.count() == 5  # the batch form keeps the late row


def test_comment_stats_window_split_over_batches(spark, scratch):
    """Turns 0-1 and 2 of a conversation share a 60 s window but arrive in
    different micro-batches: the additive tables must give the batch answer."""
    from vidpulse.operators import sentiment as sent
    from vidpulse.operators import text as txt
    from vidpulse.schema import STOP_WORDS
    from vidpulse.sources.fixtures import derive_lexicon, lv_comments
    from vidpulse.streaming.jobs import read_comment_views

    cm = lv_comments(spark, SF_SMALL)
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    src = os.path.join(scratch, "conv")
    conv.where("turn < 2").coalesce(1).write.parquet(src)
    conv.where("turn >= 2").coalesce(1).write.mode("append").parquet(src)
    from vidpulse.sources.fixtures import conversations_as_comments

    stream = conversations_as_comments(spark.readStream.schema(conv.schema).option("maxFilesPerTrigger", 1).parquet(src))
    lex = derive_lexicon(cm)
    q, tables = start_comment_stats(stream, scratch, lex, STOP_WORDS, trigger={"availableNow": True})
    q.awaitTermination()
    assert len(q.recentProgress) >= 2
    views = read_comment_views(spark, tables)
    sentences = txt.comment_sentences(cm)
    want = {
        "comment_sentiment": sent.mean_sentiment(sent.sentence_sentiment(sentences, lex)),
        "comment_words": txt.top_words(txt.word_counts(cm, STOP_WORDS)),
        "comment_tokens": txt.token_stats(sentences),
    }
    for name, df in want.items():
        cols = sorted(df.columns)
        assert _rows(views[name], cols) == _rows(df, cols), name


def test_stream_windows_independent_of_session_zone(spark):
    from vidpulse.streaming.jobs import run_reaction_counts_once

    want = _rows(counts.typed_window_counts(events_as_video_events(
        spark.read.parquet(f"{SF_SMALL}/events.parquet")), "like", "6 hours"), ["video_id", "window_start", "n"])
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = _rows(run_reaction_counts_once(spark, SF_SMALL, "like", "6 hours"), ["video_id", "window_start", "n"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want


def test_stream_dedup_within_watermark(spark, scratch):
    from vidpulse.operators.misc import dedup_events
    from vidpulse.streaming.sinks import console_sink

    src = os.path.join(scratch, "dups")
    rows = [_ev(3600), _ev(3601), _ev(3600), _ev(3602, "like")]  # one exact re-delivery
    _json_file(src, "a.json", rows)
    _json_file(src, "b.json", [_ev(3601), _ev(3603)])  # re-delivered in a later batch
    os.utime(os.path.join(src, "b.json"), (os.path.getmtime(os.path.join(src, "a.json")) + 5,) * 2)
    stream = read_event_lines(spark, src, streaming=True, max_files_per_trigger=1)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    keys = ["video_id", "user_id", "event_type", "timestamp"]
    deduped = dedup_events(stream, keys, watermark="1 hour")
    out = os.path.join(scratch, "out")
    q = (deduped.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 4
    cq = console_sink(read_event_lines(spark, src, streaming=True), mode="append", trigger={"availableNow": True})
    cq.awaitTermination()
    assert cq.exception() is None


def test_bucketed_totals_evict_state(spark, scratch):
    from vidpulse.streaming.jobs import bucketed_totals_stream_df, totals_from_buckets

    src = os.path.join(scratch, "src")
    schema, chunks = _time_chunks(spark, SF_SMALL, 4)
    _append(chunks, src)
    table = UpsertTable(os.path.join(scratch, "buckets"), ["video_id", "window_start"])
    q = upsert_sink(bucketed_totals_stream_df(_stream(spark, src, schema), "1 day"), table,
                    os.path.join(scratch, "ck"), {"availableNow": True})
    q.awaitTermination()
    buckets = table.read(spark)
    state_rows = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert state_rows < buckets.count() / 4  # closed days were evicted from state
    want = counts.running_totals(events_as_video_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
                                 .where("event_type in ('like','dislike','play','leave')"))
    cols = ["video_id", "likes", "dislikes", "plays", "leaves"]
    assert _rows(totals_from_buckets(buckets), cols) == _rows(want, cols)


def test_exact_window_sampling_over_closed_windows(spark, scratch):
    """Append-mode sentence counts deliver each window complete, even when its
    comments arrive in two micro-batches: closed windows equal the batch
    answer, and with a capacity the window's whole load is shed."""
    from vidpulse.operators import text as txt
    from vidpulse.plans.comment_stats import comment_histogram
    from vidpulse.schema import STOP_WORDS
    from vidpulse.sources.fixtures import conversations_as_comments, derive_lexicon, lv_comments
    from vidpulse.streaming.jobs import read_comment_views, start_comment_stats_exact

    cm = lv_comments(spark, "/root/testdata/sf0.01")
    conv = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    src = os.path.join(scratch, "conv")
    conv.where("turn < 2").coalesce(1).write.parquet(src)          # window 00:00, first part
    conv.where("turn >= 2").coalesce(1).write.mode("append").parquet(src)
    stream = conversations_as_comments(spark.readStream.schema(conv.schema).option("maxFilesPerTrigger", 1).parquet(src))
    lex = derive_lexicon(cm)
    q, tables = start_comment_stats_exact(stream, scratch, lex, STOP_WORDS, watermark="10 seconds",
                                          trigger={"availableNow": True})
    q.awaitTermination()
    views = read_comment_views(spark, tables)
    closed = "window_start < timestamp_ntz'2024-01-01 00:02:00'"  # the last window is still open
    want_sent = sent_mean(comment_histogram(cm, lex)).where(closed)
    got = views["comment_sentiment"]
    assert got.count() > 0 and got.where(f"not ({closed})").count() == 0
    cols = ["video_id", "window_start", "score", "n"]
    assert _rows(got, cols) == _rows(want_sent, cols)
    tok_cols = ["video_id", "window_start", "n_sentences", "n_tokens"]
    assert _rows(views["comment_tokens"], tok_cols) == _rows(txt.token_stats(txt.comment_sentences(cm)).where(closed), tok_cols)


def test_streams_read_folders_in_any_order(spark, scratch):
    """Every registered stream over tables of four part files in mixed time
    order equals its batch answer; nothing is dropped as late."""
    from vidpulse.plans import registry as R

    for t in ("events", "conversations"):
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        df.repartition(4, F.rand(3)).write.parquet(os.path.join(scratch, f"{t}.parquet"))
    assert len([f for f in os.listdir(os.path.join(scratch, "events.parquet")) if f.startswith("part-")]) == 4
    pairs = {"likes_tumbling_stream": "likes_tumbling", "sliding_counts_stream": "sliding_counts", "totals_stream": "running_totals",
             "totals_bucketed_stream": "running_totals", "sampled_sentiment_stream": "sampled_sentiment"}
    for stream, batch in pairs.items():
        want = R.QUERIES[batch](spark, SF_SMALL)
        assert _rows(R.QUERIES[stream](spark, scratch), sorted(want.columns)) == _rows(want, sorted(want.columns)), stream


def test_a_bounded_run_fails_on_late_rows(spark, scratch):
    import pytest

    from vidpulse.streaming import jobs

    src = os.path.join(scratch, "late")
    for i, rows in enumerate([[_ev(3600)], [_ev(3780)], [_ev(2880), _ev(3840)]]):
        _json_file(src, f"{i}.json", rows)
        os.utime(os.path.join(src, f"{i}.json"), (1_700_000_000 + 5 * i,) * 2)
    stream = read_event_lines(spark, src, streaming=True, max_files_per_trigger=1)
    table = UpsertTable(os.path.join(scratch, "t"), ["video_id", "window_start"])
    with pytest.raises(RuntimeError, match="1 rows were dropped"):
        jobs._run_once(reaction_counts_stream(stream, "play", "10 minutes"), table, os.path.join(scratch, "ck"))


def sent_mean(hist):
    from vidpulse.operators.sentiment import mean_sentiment

    return mean_sentiment(hist)


def test_state_partitions_restores_session_value(spark):
    from vidpulse.session import state_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_partitions(spark, 2):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
