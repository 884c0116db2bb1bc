"""Sliding windows from panes, box queries over the sorted layout, viewer lows."""

import random

import pytest
from pyspark.sql import functions as F

from core_paths import SF_SMALL
from vidpulse.operators import boxes, counts, viewers
from vidpulse.operators.boxes import Box
from vidpulse.sources.fixtures import lv_events


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _by_copies(df, length, slide, keys, value=None):
    """Each row copied to all its windows."""
    agg = F.count(F.lit(1)) if value is None else F.sum(value)
    g = df.groupBy(F.window("ts", length, slide).alias("w"), *keys).agg(agg.cast("bigint").alias("n"))
    return g.select(*keys, F.col("w.start").alias("window_start"), "n")


@pytest.mark.parametrize("length,slide", [("30 seconds", "10 seconds"), ("10 seconds", "10 seconds"), ("60 seconds", "20 seconds"), ("50 seconds", "7 seconds")])
def test_panes_equal_copies(spark, length, slide):
    rng = random.Random(2)
    rows = [(rng.randrange(3), rng.choice([0, 1, 5, 9, 10, 11, 29, 30, 100, 600, 3599, 86400]) + rng.randrange(40), rng.choice([1, -1])) for _ in range(300)]
    df = spark.createDataFrame(rows, "video_id long, s long, d int").withColumn("ts", F.timestamp_seconds("s"))
    for value in (None, F.col("d")):
        got = counts.window_counts(df, length, slide, value=value).select("video_id", "window_start", "n")
        assert _rows(got) == _rows(_by_copies(df, length, slide, ["video_id"], value))


def test_a_row_is_not_copied_before_the_shuffle(spark):
    ev = lv_events(spark, SF_SMALL, list(counts.REACTION_TYPES))
    plan = counts.sliding_counts(ev, "6 hours", "2 hours")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("Aggregate") == 2
    below = plan[plan.rindex("Aggregate"):]
    assert "Generate" not in below and "explode" not in below


def test_ranges_cover_the_box_and_no_more_than_asked(spark):
    rng = random.Random(3)
    for most in (1, 4, 16, 64, 300):
        for _ in range(40):
            south, west = rng.uniform(-95, 89), rng.uniform(-185, 179)
            box = Box(south, west, south + rng.choice([0, 1e-6, 0.01, 3, 60]), min(185, west + rng.choice([0, 1e-6, 0.01, 3, 60])))
            ranges = boxes.cell_ranges(box, most)
            assert 1 <= len(ranges) <= max(1, most) and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))
            for _ in range(30):
                lat, lon = rng.uniform(box.south, box.north), rng.uniform(box.west, box.east)
                cell = boxes._interleave(boxes._axis_of(lat, -90, 180), boxes._axis_of(lon, -180, 360))
                assert any(a <= cell <= b for a, b in ranges)


def test_cell_numbers_equal_interleaved_bits(spark):
    rng = random.Random(4)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (120.0, -999.0)]
    df = spark.createDataFrame(places, "latitude double, longitude double")
    got = [r[0] for r in df.select(boxes.cell_number(F.col("latitude"), F.col("longitude"))).collect()]
    assert got == [boxes._interleave(boxes._axis_of(a, -90, 180), boxes._axis_of(b, -180, 360)) for a, b in places]


def test_searches_equal_the_plain_condition(spark, scratch):
    rng = random.Random(5)
    rows = [(k, rng.uniform(-90, 90), rng.uniform(-180, 180)) for k in range(3000)]
    rows += [(9000 + k, 12.5, 179.99) for k in range(1500)]  # one place with a third of the rows
    rows += [(1, None, 3.0), (2, 3.0, None), (3, float("nan"), 1.0), (4, 90.0, 180.0), (5, -90.0, -180.0)]
    df = spark.createDataFrame(rows, "event_id long, latitude double, longitude double")
    boxes.write_places(df, scratch, files=6)
    places = boxes.read_places(spark, scratch)
    assert places.count() == len(rows)
    assert places.where("latitude = 12.5").select(F.input_file_name()).distinct().count() > 1
    cell = 180 / 2**boxes.BITS
    for box in (Box(-10, -20, 10, 20), Box(12, 170, 13, -170), Box(12.5, 179.99, 12.5, 179.99), Box(-90, -180, 90, 180), Box(5, 5, 1, 9),
                Box(-cell, -cell, cell, cell), Box(-cell / 2, -cell / 2, cell / 2, cell / 2), Box(90, 180, 90, 180)):
        want = _rows(df.where(boxes.in_box(box)))
        assert _rows(boxes.search(places, box).drop("cell")) == want
        assert _rows(boxes.search(places, box, most=3).drop("cell")) == want


def test_ranges_reach_the_scan_and_skip_files(spark, scratch):
    df = spark.range(20_000).select(F.col("id").alias("event_id"), (F.col("id") % 141 - 70).cast("double").alias("latitude"), (F.col("id") % 331 - 165).cast("double").alias("longitude"))
    boxes.write_places(df, scratch, files=8, row_group_bytes=64 << 10)
    found = boxes.search(boxes.read_places(spark, scratch), Box(10, 20, 14, 26))
    assert found.count() == df.where(boxes.in_box(Box(10, 20, 14, 26))).count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOr" in plan[plan.index("PushedFilters"):]
    found.collect()
    node = found._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    assert node.metrics().apply("numOutputRows").value() < 20_000 / 4


def test_viewer_lows(spark):
    rows = [(1, 1, "play", 1), (2, 1, "leave", 2), (3, 1, "leave", 3), (4, 1, "leave", 4), (5, 1, "play", 5), (6, 1, "play", 6), (7, 1, "leave", 6),
            (8, 2, "play", 1), (9, 2, "play", 2), (10, 3, "leave", 9)]
    df = spark.createDataFrame(rows, "event_id long, video_id long, event_type string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = viewers.viewer_lows(df).select("video_id", "lowest", F.unix_seconds("lowest_at"), F.unix_seconds("negative_at")).orderBy("video_id").collect()
    assert list(map(tuple, got)) == [(1, -2, 4, 3), (2, 1, 1, None), (3, -1, 9, 9)]


def test_lows_of_a_hot_video_are_spread(spark):
    n = 4000
    df = spark.range(n).select(F.col("id").alias("event_id"), F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id")).cast("long").alias("video_id"),
                               F.when(F.col("id") % 2 == 0, "leave").otherwise("play").alias("event_type"), F.timestamp_seconds("id").alias("ts"))
    running, low, at, below = {}, {}, {}, {}
    for r in df.orderBy("event_id").collect():
        v = running[r.video_id] = running.get(r.video_id, 0) + (1 if r.event_type == "play" else -1)
        if r.video_id not in low or v < low[r.video_id]:
            low[r.video_id], at[r.video_id] = v, r.ts
        if v < 0:
            below.setdefault(r.video_id, r.ts)
    got = {r.video_id: (r.lowest, r.lowest_at, r.negative_at) for r in viewers.viewer_lows(df).collect()}
    assert got == {v: (low[v], at[v], below.get(v)) for v in low}
