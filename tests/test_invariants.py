"""Invariants on the fixture tables and a skewed running sum against brute force."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from core_paths import SF_SMALL
from vidpulse.operators import counts, sampling, text, viewers
from vidpulse.operators.misc import dedup_events, events_sorted
from vidpulse.operators.prefix import running_sum
from vidpulse.sources.fixtures import lv_comments, lv_events


def test_tumbling_sum_equals_events(spark):
    ev = lv_events(spark, SF_SMALL)
    total = counts.typed_window_counts(ev, "like", "6 hours").agg(F.sum("n")).first()[0]
    assert total == ev.where("event_type = 'like'").count()


def test_sliding_counts_each_event_three_times(spark):
    ev = lv_events(spark, SF_SMALL)
    s = counts.sliding_counts(ev, "6 hours", "2 hours").agg(F.sum("n")).first()[0]
    assert s == 3 * ev.where("event_type in ('like','dislike','play','leave')").count()


def test_zero_fill_keeps_totals(spark):
    ev = lv_events(spark, SF_SMALL)
    s = counts.sliding_counts(ev, "6 hours", "2 hours")
    z = counts.fill_zero_windows(s, "2 hours")
    assert z.agg(F.sum("n")).first()[0] == s.agg(F.sum("n")).first()[0]
    assert z.where("n = 0").count() > 0


def test_last_running_count_is_total(spark):
    ev = lv_events(spark, SF_SMALL)
    last = viewers.running_count(ev, "play").groupBy("video_id").agg(F.max("running").alias("m"))
    tot = ev.where("event_type = 'play'").groupBy("video_id").count()
    assert last.join(tot, "video_id").where("m != count").count() == 0


def test_sampling_with_large_capacity_keeps_all(spark):
    cm = lv_comments(spark, SF_SMALL)
    sent = text.comment_sentences(cm)
    probs = sampling.window_keep_probability(cm, capacity=10**12)
    assert sampling.adaptive_sample(sent, probs).count() == sent.count()


def test_sampling_rand_draw_runs(spark):
    cm = lv_comments(spark, SF_SMALL)
    probs = sampling.window_keep_probability(cm, capacity=100)
    kept = sampling.adaptive_sample(text.comment_sentences(cm), probs, draw="rand", seed=7).count()
    assert 0 < kept < text.comment_sentences(cm).count()


def test_events_sorted_positions(spark):
    ev = lv_events(spark, SF_SMALL)
    pos = events_sorted(ev)
    n = ev.count()
    agg = pos.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()
    assert tuple(agg) == (1, n, n)


def test_dedup_removes_copies(spark):
    ev = lv_events(spark, SF_SMALL)
    assert dedup_events(ev.unionByName(ev).unionByName(ev)).count() == ev.count()


def test_running_sum_hot_key_split(spark):
    """70% of rows on one key: range partitions split it; results match a
    plain window."""
    base = spark.range(0, 20000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 37).alias("k"),
        (F.col("id") * 7919 % 5003).alias("t"),
        (F.col("id") % 3 - 1).alias("w"),
    )
    got = running_sum(base, ["t", "event_id"], ["k"], F.col("w"), num_partitions=16)
    parts = (base.repartitionByRange(16, "k", "t", "event_id").where("k = 0")
             .select(F.spark_partition_id().alias("p")).distinct().count())
    assert parts > 4
    bf = base.withColumn("bf", F.sum("w").over(
        Window.partitionBy("k").orderBy("t", "event_id").rowsBetween(Window.unboundedPreceding, 0)))
    j = got.join(bf.select("event_id", "bf"), "event_id")
    assert j.count() == 20000
    assert j.where("running != bf").count() == 0


def test_global_running_sum_many_partitions(spark):
    base = spark.range(0, 5000).select(F.col("id").alias("event_id"), (F.col("id") * 31 % 977).alias("t"))
    got = running_sum(base, ["t", "event_id"], [], None, "pos", num_partitions=12)
    bf = base.withColumn("bf", F.row_number().over(Window.orderBy("t", "event_id")))
    assert got.join(bf, ["event_id"]).where("pos != bf").count() == 0


def test_serving_path_equals_single_pass_summary(spark):
    from vidpulse.plans.dashboard import video_summary, videos_from_serving

    ev = lv_events(spark, SF_SMALL)
    tot = counts.running_totals(ev)
    plays = tot.select("video_id", F.col("plays").alias("n")).where("n > 0")
    leaves = tot.select("video_id", F.col("leaves").alias("n")).where("n > 0")
    starts = viewers.latest_record(ev, "start_video", ("latitude", "longitude"))
    likes = counts.latest_window(counts.typed_window_counts(ev, "like", "6 hours"))
    dislikes = counts.latest_window(counts.typed_window_counts(ev, "dislike", "6 hours"))
    cols = ["video_id", "plays", "leaves", "views", "out_of_order", "latitude", "longitude", "likes", "dislikes"]
    a = sorted(tuple(r) for r in videos_from_serving(plays, leaves, starts, likes, dislikes).select(*cols).collect())
    b = sorted(tuple(r) for r in video_summary(ev, "6 hours").select(*cols).collect())
    assert a == b and len(a) > 0


def test_running_sum_of_wide_rows(spark):
    """More than a million rows, a hot key and a column that the sum does not need."""
    n = 1_200_000
    base = spark.range(n).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).alias("k"),
        (F.col("id") * 7919 % 100_003).alias("t"), F.concat(F.lit("payload "), F.col("id")).alias("extra"))
    got = running_sum(base, ["t", "event_id"], ["k"], num_partitions=8)
    w = Window.partitionBy("k").orderBy("t", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = base.select("event_id", F.count(F.lit(1)).over(w).alias("want"))
    both = got.join(want, "event_id")
    assert both.where("running = want").count() == n
    assert got.where("extra = concat('payload ', event_id)").count() == n
