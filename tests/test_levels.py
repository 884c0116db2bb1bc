"""Levelled serving tables: writer, reader and merge interleaved."""

import random

import pytest
from pyspark.sql import functions as F

from vidpulse.sources import folders
from vidpulse.streaming.levels import LevelledTable, Manifest

SCHEMA = "k long, v long, note string"


def _batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def _snapshot(table, spark):
    return {r.k: (r.v, r.note) for r in table.read(spark).collect()}


def test_writer_reader_and_merge_interleaved(spark, scratch):
    rng = random.Random(1)
    table = LevelledTable(scratch, ["k"], merge_every=None, level_rows=12, fanout=3, file_rows=20)
    want, old_reads = {}, []
    for batch_id in range(14):
        rows = [(k, rng.randrange(100), None if k % 5 == 0 else f"b{batch_id}") for k in rng.sample(range(40), 6)]
        table.write_batch(_batch(spark, rows), batch_id)
        if batch_id % 4 == 1:  # the last batch delivered again
            table.write_batch(_batch(spark, rows), batch_id)
        want.update({k: (v, n) for k, v, n in rows})
        if batch_id % 3 == 2:
            old_reads.append((table.read(spark), dict(want)))
            assert table.merge(spark)
            if batch_id % 2:
                table.write_batch(_batch(spark, rows), batch_id)  # and once more, now that it is merged
            table.vacuum(spark)
        assert _snapshot(table, spark) == want
        assert len(table.runs(spark)) <= 3 + 4  # unmerged batches and levels
    for frame, then in old_reads[-2:]:  # reads that began before the last merges see what they saw then
        assert {r.k: (r.v, r.note) for r in frame.collect()} == then
    assert len(table.manifest(spark).runs) > 1
    table.compact(spark)
    assert len(table.runs(spark)) == 1 and _snapshot(table, spark) == want
    assert not table.merge(spark)


def test_levels_stay_within_their_sizes(spark, scratch):
    table = LevelledTable(scratch, ["k"], merge_every=2, level_rows=4, fanout=2)
    for batch_id in range(24):
        table(_batch(spark, [(batch_id * 2, 1, "x"), (batch_id * 2 + 1, 1, "y")]), batch_id)
        runs = table.manifest(spark).runs
        assert len({r.level for r in runs}) == len(runs) and all(r.rows <= table.level_limit(r.level) for r in runs)
        assert len(table.runs(spark)) <= 2 + 5
    assert table.read(spark).count() == 48
    assert len(folders.names(spark, f"{scratch}/batches")) <= 8  # merged batches go


def test_sums_add_over_batches_and_merges(spark, scratch):
    table = LevelledTable(scratch, ["k"], sums=["v"], merge_every=2, level_rows=3, fanout=2)
    for batch_id in range(9):
        table(_batch(spark, [(k, batch_id, None) for k in range(batch_id % 4 + 1)]).drop("note"), batch_id)
        table(_batch(spark, [(k, batch_id, None) for k in range(batch_id % 4 + 1)]).drop("note"), batch_id)  # delivered twice
    want = {k: sum(b for b in range(9) if b % 4 >= k) for k in range(4)}
    assert {r.k: r.v for r in table.read(spark).collect()} == want


def test_unfinished_runs_do_not_count(spark, scratch):
    table = LevelledTable(scratch, ["k"], merge_every=None)
    with pytest.raises(ValueError):
        table.read(spark)
    table.write_batch(_batch(spark, [(1, 1, "whole")]), 0)
    name = "batch=1-" + "0" * 32
    _batch(spark, [(1, 2, "cut")]).write.parquet(f"{scratch}/batches/{name}")
    folders.remove(spark, f"{scratch}/batches/{name}/_SUCCESS")  # the writer died
    assert _snapshot(table, spark) == {1: (1, "whole")}
    table.merge(spark)
    assert table.manifest(spark).upto == 0
    table.write_batch(_batch(spark, [(1, 3, "again")]), 1)
    assert _snapshot(table, spark) == {1: (3, "again")}


def test_of_two_merges_at_a_time_one_wins(spark, scratch, monkeypatch):
    table = LevelledTable(scratch, ["k"], merge_every=None)
    table.write_batch(_batch(spark, [(1, 1, "a")]), 0)
    before = table.manifest(spark)
    assert before == Manifest()
    assert table.merge(spark)
    table.write_batch(_batch(spark, [(2, 2, "b")]), 1)
    slow = LevelledTable(scratch, ["k"], merge_every=None)
    monkeypatch.setattr(slow, "manifest", lambda _: before)  # what it read before the other published
    assert not slow.merge(spark)
    assert _snapshot(table, spark) == {1: (1, "a"), 2: (2, "b")}
    assert len(folders.names(spark, f"{scratch}/runs")) == 1


def test_a_new_checkpoint_needs_a_new_table(spark, scratch):
    table = LevelledTable(scratch, ["k"], merge_every=None)
    for batch_id in (4, 5):
        table.write_batch(_batch(spark, [(1, batch_id, "a")]), batch_id)
    table.merge(spark)
    with pytest.raises(ValueError):
        table.write_batch(_batch(spark, [(1, 0, "z")]), 0)
    LevelledTable(scratch, ["k"], repeats="ignore").write_batch(_batch(spark, [(1, 0, "z")]), 4)
    assert _snapshot(table, spark) == {1: (5, "a")}


def test_a_look_up_reads_few_row_groups(spark, scratch):
    table = LevelledTable(scratch, ["k"], merge_every=None, level_rows=10**6, file_rows=1000)
    table.write_batch(spark.range(8000).select(F.col("id").alias("k"), F.lit(1).alias("v")), 0)
    table.merge(spark)
    found = table.read(spark).where("k = 4321")
    assert [r.v for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,4321)" in plan  # the filter goes below the fold, to the sorted files
    files = spark.read.parquet(*table.runs(spark)).groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("a").collect()
    assert len(files) == 8 and all(x.b < y.a for x, y in zip(files, files[1:]))
