"""Streaming sinks end to end with the file source (availableNow)."""

import os

import pytest
from pyspark.sql import functions as F

from core_paths import SF_SMALL
from vidpulse.operators import counts
from vidpulse.operators.routing import route_events, routed_counts
from vidpulse.schema import STOP_WORDS
from vidpulse.sources.envelope import encode_envelope, sim_timestamp
from vidpulse.sources.events import read_archive, read_table_stream
from vidpulse.sources.fixtures import derive_lexicon, events_as_video_events, lv_comments, lv_events
from vidpulse.streaming import jobs
from vidpulse.streaming.sinks import archive_sink, routed_sink, table_sink, text_sink

ONCE = {"availableNow": True}


def _events_stream(spark):
    return events_as_video_events(read_table_stream(spark, SF_SMALL, "events"))


def test_routed_sink_files_by_topic(spark, scratch):
    ev = _events_stream(spark).withColumn("timestamp", sim_timestamp(F.col("ts")))
    wire = encode_envelope(route_events(ev))
    q = routed_sink(wire, None, os.path.join(scratch, "out"), os.path.join(scratch, "ck"), ONCE)
    q.awaitTermination()
    got = {r.topic: r.n for r in spark.read.json(os.path.join(scratch, "out")).groupBy("topic")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    want = {r.topic: r.n for r in routed_counts(lv_events(spark, SF_SMALL)).collect()}
    assert got == want


def test_archive_sink_and_replay(spark, scratch):
    q = archive_sink(route_events(_events_stream(spark)), os.path.join(scratch, "arch"),
                     os.path.join(scratch, "ck"), ONCE)
    q.awaitTermination()
    back = read_archive(spark, os.path.join(scratch, "arch"), topics=["play_topic", "leave_topic"])
    want = lv_events(spark, SF_SMALL).where("event_type in ('play', 'leave')")
    assert back.count() == want.count()
    cols = ["video_id", "plays", "leaves"]
    from vidpulse.operators.viewers import concurrent_views

    a = sorted(tuple(r) for r in concurrent_views(back).select(*cols).collect())
    b = sorted(tuple(r) for r in concurrent_views(want).select(*cols).collect())
    assert a == b


def test_text_sink_append_closed_windows(spark, scratch):
    counts_stream = jobs.reaction_counts_stream(_events_stream(spark), "like", "6 hours", watermark="6 hours")
    q = text_sink(counts_stream, os.path.join(scratch, "txt"), os.path.join(scratch, "ck"), "json", ONCE)
    q.awaitTermination()
    out = spark.read.schema("video_id long, window_start timestamp_ntz, n long").json(os.path.join(scratch, "txt"))
    batch = counts.typed_window_counts(lv_events(spark, SF_SMALL), "like", "6 hours")
    emitted = out.count()
    assert emitted > 0
    # every emitted (closed) window equals its batch count
    assert out.join(batch, ["video_id", "window_start"]).where(out.n == batch.n).count() == emitted


def test_table_sink_generic_writer(spark, scratch):
    totals = jobs.totals_stream_df(_events_stream(spark))
    q = table_sink(totals, "parquet", {"path": os.path.join(scratch, "tbl")}, os.path.join(scratch, "ck"),
                   trigger=ONCE)
    q.awaitTermination()
    videos = lv_events(spark, SF_SMALL).select("video_id").distinct().count()
    assert spark.read.parquet(os.path.join(scratch, "tbl")).count() == videos
    # the same batch delivered again (checkpoint lost) writes the same folder
    q = table_sink(jobs.totals_stream_df(_events_stream(spark)), "parquet", {"path": os.path.join(scratch, "tbl")},
                   os.path.join(scratch, "ck2"), trigger=ONCE)
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(scratch, "tbl")).count() == videos
    with pytest.raises(ValueError):
        table_sink(totals, "some.connector", {"table": "t"}, os.path.join(scratch, "ck3"))


def test_start_all_writes_every_serving_table(spark, scratch):
    cm = lv_comments(spark, SF_SMALL)
    cm_dir = os.path.join(scratch, "comments_src")
    cm.write.parquet(cm_dir)
    comments = spark.readStream.schema(cm.schema).parquet(cm_dir)
    queries, tables = jobs.start_all(_events_stream(spark), comments, scratch, derive_lexicon(cm), STOP_WORDS,
                                     reaction_window="6 hours", trigger=ONCE)
    for q in queries:
        q.awaitTermination()
    assert set(tables) == {"recent_likes", "recent_dislikes", "recent_comments", "totals", "video_start", "video_end",
                           "comment_sentiment", "comment_words", "comment_tokens", "comment_sentences"}
    for name, t in tables.items():
        assert t.read(spark).count() > 0, name
    want = {r.video_id: r.plays for r in counts.running_totals(lv_events(spark, SF_SMALL)).collect()}
    got = {r.video_id: r.plays for r in tables["totals"].read(spark).collect()}
    assert got == want


def test_live_dashboard_equals_batch(spark, scratch):
    """Map rows from the serving tables written by the streams equal the
    batch dashboard over the same input, with default arguments."""
    from vidpulse.plans import dashboard
    from vidpulse.plans.live import live_map_features

    cm = lv_comments(spark, SF_SMALL)
    cm_dir = os.path.join(scratch, "comments_src")
    cm.write.parquet(cm_dir)
    comments = spark.readStream.schema(cm.schema).parquet(cm_dir)
    lex = derive_lexicon(cm)
    queries, tables = jobs.start_all(_events_stream(spark), comments, scratch, lex, STOP_WORDS,
                                     reaction_window="6 hours", trigger=ONCE)
    for q in queries:
        q.awaitTermination()
    live = live_map_features(spark, tables)
    batch = dashboard.map_features(dashboard.dashboard_inputs(lv_events(spark, SF_SMALL), cm, STOP_WORDS, lex,
                                                              "6 hours"))
    cols = sorted(batch.columns)
    a = sorted(tuple(r[c] for c in cols) for r in live.collect())
    b = sorted(tuple(r[c] for c in cols) for r in batch.collect())
    assert len(a) > 0 and a == b


def test_app_once_on_json_lines(spark, scratch):
    """The application entry point over event lines (comments in the same stream)."""
    import json as _json

    from vidpulse.streaming.app import main

    src = os.path.join(scratch, "lines")
    os.makedirs(src)
    lines = [
        {"user_id": 1, "event_type": "start_video", "timestamp": 1.0, "video_id": 304, "latitude": 40.0, "longitude": -100.0},
        *[{"user_id": 10 + i, "event_type": "play", "timestamp": 1.0 + 0.1 * i, "video_id": 304, "latitude": 40.0,
           "longitude": -100.0} for i in range(14)],
        *[{"user_id": 10 + i, "event_type": "leave", "timestamp": 3.0 + 0.1 * i, "video_id": 304, "latitude": 40.0,
           "longitude": -100.0} for i in range(5)],
        {"user_id": 3, "event_type": "like", "timestamp": 1.3, "video_id": 304, "latitude": 40.0, "longitude": -100.0},
        {"user_id": 4, "event_type": "comment", "timestamp": 1.4, "video_id": 304, "latitude": 40.0,
         "longitude": -100.0, "comment": "Great show. Great fun!"},
    ]
    with open(os.path.join(src, "events.json"), "w") as f:
        f.write("".join(_json.dumps(e) + "\n" for e in lines))
    lex_path = os.path.join(scratch, "lexicon")
    spark.createDataFrame([("great", 2), ("fun", 1)], "word string, score long").write.parquet(lex_path)
    with open(os.path.join(src, "again.json"), "w") as f:  # the play lines delivered again, and two that are no events
        f.write("".join(_json.dumps(e) + "\n" for e in lines if e["event_type"] == "play") + "junk\n" + "{}\n")
    seed = os.path.join(scratch, "seed")
    spark.createDataFrame([(304, 100, 0, 0, 0, 7), (9, 1, 2, 3, 4, 5)], "video_id long, likes long, dislikes long, plays long, leaves long, comments long").write.parquet(seed)
    archive = os.path.join(scratch, "archive")
    tables = main(["--events", src, "--lexicon", lex_path, "--out", os.path.join(scratch, "serving"), "--once",
                   "--archive", archive, "--dedup", "1 hour"])
    going_on = main(["--events", src, "--lexicon", lex_path, "--out", os.path.join(scratch, "seeded"), "--once",
                     "--dedup", "1 hour", "--totals-seed", seed])
    seeded = {r.video_id: r for r in going_on["totals"].read(spark).collect()}
    assert (seeded[304].likes, seeded[304].plays, seeded[304].comments) == (101, 14, 8)
    assert (seeded[9].likes, seeded[9].comments) == (1, 5)
    assert tables["bad_records"].read(spark).first().n == 2
    assert tables["recent_comments"].read(spark).count() == 3
    exact = main(["--events", src, "--lexicon", lex_path, "--out", os.path.join(scratch, "serving_exact"), "--once",
                  "--exact-windows"])
    # the single comment's window is still open (no later event moved the watermark past it)
    assert exact["comment_tokens"].read(spark).count() == 0
    assert read_archive(spark, archive).count() == len(lines)
    tot = tables["totals"].read(spark).where("video_id = 304").first()
    assert (tot.plays, tot.leaves, tot.likes) == (14, 5, 1)
    from vidpulse.plans.live import live_popup_text

    from vidpulse.plans.live import main as live_main
    from vidpulse.streaming.jobs import serving_tables

    # a reader in another process only needs the root folder
    reread = serving_tables(os.path.join(scratch, "serving"))
    assert reread["totals"].read(spark).where("video_id = 304").first().plays == 14
    live_main(["--serving", os.path.join(scratch, "serving"), "--out", os.path.join(scratch, "map")])
    assert spark.read.parquet(os.path.join(scratch, "map")).where("video_id = 304").first().views == 9
    from vidpulse.plans.live import register_serving_views

    register_serving_views(spark, reread)
    assert spark.sql("SELECT plays - leaves AS v FROM totals WHERE video_id = 304").first().v == 9
    pop = live_popup_text(spark, tables).where("video_id = 304").first()
    assert pop.label_views == "Concurent viewers: 9"
    assert pop.label_words == "Top popular words: [('great', 2), ('fun', 1), ('show', 1)]"
    assert pop.label_sentiment == "Sentiment score: 4.0"  # both sentences: mean 2 and 1.5 -> class 4


def test_replay_from_archive_feeds_live_dashboard(spark, scratch):
    """Archive events and comments, replay them as one batch into serving
    tables, and build the live map from those: equal to the batch map."""
    from vidpulse.plans import dashboard
    from vidpulse.plans.live import live_map_features
    from vidpulse.plans.replay import replay_serving_tables
    from vidpulse.operators.routing import with_comments
    from vidpulse.streaming.sinks import write_archive

    ev, cm = lv_events(spark, SF_SMALL), lv_comments(spark, SF_SMALL)
    archive = os.path.join(scratch, "archive")
    write_archive(route_events(with_comments(ev, cm)), archive)
    lex = derive_lexicon(cm)
    tables = replay_serving_tables(spark, archive, os.path.join(scratch, "serving"), lex, STOP_WORDS,
                                   reaction_window="6 hours")
    live = live_map_features(spark, tables)
    batch = dashboard.map_features(dashboard.dashboard_inputs(ev, cm, STOP_WORDS, lex, "6 hours"))
    cols = sorted(batch.columns)
    assert sorted(tuple(r[c] for c in cols) for r in live.collect()) == \
        sorted(tuple(r[c] for c in cols) for r in batch.collect())
