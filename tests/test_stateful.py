"""Running counts with keyed state: any order, restart, seed, eviction."""

import os
import shutil

from pyspark.sql import functions as F

from core_paths import SF_SMALL
from vidpulse.operators import viewers
from vidpulse.session import state_partitions
from vidpulse.sources.fixtures import lv_events
from vidpulse.streaming import stateful
from vidpulse.streaming.jobs import _finish
from vidpulse.streaming.sinks import UpsertTable

ONCE = {"availableNow": True}
SCHEMA = "event_id long, video_id long, event_type string, ts timestamp"


def _file(spark, path, rows):
    """rows: (event_id, video_id, type, second); a mark of time has no id."""
    df = spark.createDataFrame(rows, "event_id long, video_id long, event_type string, s long")
    df.select("event_id", "video_id", "event_type", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def _run(spark, counted, scratch, finish=True):
    table = UpsertTable(f"{scratch}/table", ["event_id"])
    with state_partitions(spark, 2):
        q = stateful.start_running(counted, table, f"{scratch}/checkpoint", ONCE)
        _finish(q) if finish else q.awaitTermination()
    return {r.event_id: r.running for r in table.read(spark).collect()}


def test_equals_batch_in_any_order_with_a_restart(spark, scratch):
    plays = lv_events(spark, SF_SMALL, ["play"]).select("event_id", "video_id", "event_type", "ts")
    _, delay = stateful.disordered_input(plays, f"{scratch}/all", 4)
    files = sorted((f for f in os.listdir(f"{scratch}/all") if f.endswith(".parquet")), key=lambda f: os.path.getmtime(f"{scratch}/all/{f}"))
    assert len(files) == 5
    os.makedirs(f"{scratch}/input")
    for run, some in enumerate((files[:2], files[2:])):  # the second run goes on from the checkpoint
        for f in some:
            shutil.copy2(f"{scratch}/all/{f}", f"{scratch}/input/{f}")
        got = _run(spark, stateful.running_count_stream(_stream(spark, f"{scratch}/input"), "play", delay), scratch)
        assert run or not got  # nothing is final while earlier records may come
    want = {r.event_id: r.running for r in viewers.running_count(lv_events(spark, SF_SMALL, ["play"]), "play").collect()}
    assert got == want


def test_records_go_as_the_watermark_passes_them(spark, scratch):
    path = f"{scratch}/input"
    _file(spark, path, [(3, 1, "play", 30), (1, 1, "play", 10), (2, 1, "play", 10)])
    _file(spark, path, [(4, 1, "play", 45), (5, 2, "play", 35)])  # passes 35
    got = _run(spark, stateful.running_count_stream(_stream(spark, path), "play", "10 seconds"), scratch)
    assert got == {1: 1, 2: 2, 3: 3, 5: 1}
    _file(spark, path, [(6, 1, "play", 40), (None, None, None, 100)])
    got = _run(spark, stateful.running_count_stream(_stream(spark, path), "play", "10 seconds"), scratch)
    assert got == {1: 1, 2: 2, 3: 3, 5: 1, 6: 4, 4: 5}


def test_seed_is_read_once(spark, scratch):
    path, seed = f"{scratch}/input", f"{scratch}/seed"
    spark.createDataFrame([(1, 100), (9, 5)], "video_id long, running long").write.parquet(seed)
    _file(spark, path, [(1, 1, "play", 10), (2, 2, "play", 11), (None, None, None, 50)])
    count = lambda: stateful.running_count_stream(_stream(spark, path), "play", "1 second", seed=spark.read.schema("video_id long, running long").parquet(seed))
    assert _run(spark, count(), scratch) == {1: 101, 2: 1}
    spark.createDataFrame([(1, 7), (9, 7)], "video_id long, running long").write.mode("overwrite").parquet(seed)  # not read any more
    _file(spark, path, [(3, 1, "play", 60), (4, 9, "play", 61), (None, None, None, 100)])
    assert _run(spark, count(), scratch) == {1: 101, 2: 1, 3: 102, 4: 6}


def test_idle_videos_lose_their_state(spark, scratch):
    path = f"{scratch}/input"
    for rows in ([(1, 1, "play", 10), (2, 2, "play", 10)], [(3, 2, "play", 40), (None, None, None, 60)], [(None, None, None, 75)],
                 [(4, 1, "play", 90), (5, 2, "play", 90), (None, None, None, 200)], [(6, 2, "play", 300), (None, None, None, 400)]):
        _file(spark, path, rows)
    got = _run(spark, stateful.running_count_stream(_stream(spark, path), "play", "1 second", idle_ms=50_000), scratch)
    assert got == {1: 1, 2: 1, 3: 2, 4: 1, 5: 3, 6: 1}  # video 1 was idle from 10 to 60, video 2 from 40 to 90 just not


def test_viewers_go_up_and_down(spark, scratch):
    path = f"{scratch}/input"
    _file(spark, path, [(2, 1, "leave", 20), (1, 1, "play", 10), (3, 1, "like", 21), (4, 1, "leave", 30), (None, None, None, 99)])
    table = UpsertTable(f"{scratch}/table", ["event_id"])
    with state_partitions(spark, 2):
        _finish(stateful.start_running(stateful.viewer_timeline_stream(_stream(spark, path), "1 second"), table, f"{scratch}/ck", ONCE))
    assert {r.event_id: r.viewers for r in table.read(spark).collect()} == {1: 1, 2: 0, 4: -1}


def test_null_videos_are_one_key(spark, scratch):
    path = f"{scratch}/input"
    _file(spark, path, [(k, None if k % 2 else 0, "play", k) for k in range(1, 9)])
    _file(spark, path, [(9, 0, "play", 20), (10, None, "play", 20), (None, None, None, 99)])
    got = _run(spark, stateful.running_count_stream(_stream(spark, path), "play", "1 second"), scratch)
    assert got == {**{k: (k + 1) // 2 for k in range(1, 9)}, 9: 5, 10: 5}


def test_state_calls_do_not_grow_with_the_videos(spark, scratch):
    """A state key a video made several calls a video and micro-batch."""
    path = f"{scratch}/input"
    _file(spark, path, [(k, k // 2, "play", 100 - k % 2) for k in range(4000)])
    _file(spark, path, [(4000 + k, k, "play", 90) for k in range(1500)])
    _file(spark, path, [(None, None, None, 200)])
    table = UpsertTable(f"{scratch}/table", ["event_id"])
    with state_partitions(spark, 2):
        q = stateful.start_running(stateful.running_count_stream(_stream(spark, path), "play", "20 seconds"), table, f"{scratch}/ck", ONCE)
        _finish(q)
    got = {r.event_id: r.running for r in table.read(spark).collect()}
    late = {k: (2 if k % 2 else 3) - (k // 2 >= 1500) for k in range(4000)}
    assert got == {**late, **{4000 + k: 1 for k in range(1500)}}
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) < 2000


def test_large_ids_beside_a_mark_of_time(spark, scratch, monkeypatch):
    monkeypatch.setattr(stateful, "CHUNK", 2)
    path, ids = f"{scratch}/input", [(1 << 60) + k for k in range(1, 8)]
    _file(spark, path, [*[(i, None, "play", 10) for i in ids], (None, None, None, 10)])
    _file(spark, path, [(None, None, None, 99)])
    got = _run(spark, stateful.running_count_stream(_stream(spark, path), "play", "1 second"), scratch)
    assert got == {i: k for k, i in enumerate(ids, 1)}


def test_idle_counts_restart_within_a_bucket(spark, scratch):
    """Seeds, restarts and waiting records of videos that share one bucket."""
    path = f"{scratch}/input"
    seed = spark.createDataFrame([("a", 10), ("a", 1), ("b", None), (None, 5)], "video_id string, running long")
    rows = [(1, "a", "play", 10), (2, "a", "play", 40), (3, "b", "play", 12), (4, None, "play", 70), (5, "a", "play", 41)]
    df = spark.createDataFrame(rows + [(None, None, None, 60), (None, None, None, 200)], "event_id long, video_id string, event_type string, s long")
    for upto in (60, 1000):
        part = df.where(f"s <= {upto} and s > {upto - 60 if upto == 60 else 60}")
        part.select("event_id", "video_id", "event_type", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA.replace("video_id long", "video_id string")).option("maxFilesPerTrigger", 1).parquet(path)
    counted = stateful.running_stream(stream, F.lit(1), "1 second", seed=seed, idle_ms=20_000, buckets=1)
    assert _run(spark, counted, scratch) == {1: 12, 2: 1, 5: 2, 3: 1, 4: 6}
