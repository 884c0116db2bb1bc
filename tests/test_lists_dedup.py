"""Lists in chunks with a hot key, exact dedup on a stream over restarts."""

from pyspark.sql import functions as F

from vidpulse.operators import misc, sentiment, text
from vidpulse.session import state_partitions


def _lists(chunks, keys, size):
    """Lists rebuilt from their chunks."""
    out = {}
    for r in chunks.orderBy(*keys, "chunk").collect():
        own = out.setdefault(tuple(r[k] for k in keys), [])
        assert 1 <= len(r["items"]) <= size and len(own) == r["chunk"] * size  # all but the last are full
        own.extend(r["items"])
    return out


def test_lists_of_a_hot_key_come_back_whole(spark):
    n, size = 6000, 97
    df = spark.range(n).select(F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 50).cast("long").alias("k"),
                               (F.col("id") * 7919 % 6011).alias("t"), F.when(F.col("id") % 13 != 0, F.concat(F.lit("v"), F.col("id") % 11)).alias("v"))
    want = {}
    for r in sorted(df.collect(), key=lambda r: r.t):
        want.setdefault((r.k,), []).append(r.v)
    assert _lists(text.chunked_lists(df, ["k"], ["t"], "v", size), ["k"], size) == want
    assert len(want[(1,)]) >= 0.7 * n


def test_token_and_score_lists_equal_the_collected_ones(spark):
    rows = [(1, 5 * k, f"Word{k} is good! really bad? {k} fine. " * 3) for k in range(40)] + [(2, 0, "one"), (2, 1, None), (3, 0, "..!")]
    comments = spark.createDataFrame(rows, "video_id long, s long, comment string").select("video_id", F.timestamp_seconds("s").alias("ts"), "comment")
    sentences = text.windowed(text.comment_sentences(comments))
    tokens, classes = {}, {}
    lexicon = spark.createDataFrame([("good", 2), ("bad", -2), ("fine", 1)], "word string, score long")
    score = {"good": 2, "bad": -2, "fine": 1}
    for r in sorted(sentences.collect(), key=lambda r: (r.video_id, r.ts, r.pos)):
        found = [score[w] for w in r.sentence.replace("!", " ").replace("?", " ").replace(".", " ").lower().split() if w in score]
        assert len(found) <= 1
        classes.setdefault((r.video_id, r.window_start), []).append(2 + (found[0] if found else 0))
    for r in sorted(sentences.select("*", text.token_array(F.col("sentence")).alias("t")).collect(), key=lambda r: (r.video_id, r.ts, r.pos)):
        tokens.setdefault((r.video_id, r.window_start), []).extend(r.t)
    keys = ["video_id", "window_start"]
    assert _lists(text.token_list_chunks(comments, size=16), keys, 16) == {k: v for k, v in tokens.items() if v}
    assert _lists(sentiment.score_list_chunks(text.comment_sentences(comments), lexicon, size=7), keys, 7) == classes
    by_scorer = sentiment.score_list_chunks(text.comment_sentences(comments), None, size=7, scorer=lambda s: F.length(s) % 5)
    assert sum(map(len, _lists(by_scorer, keys, 7).values())) == sum(map(len, classes.values()))


SCHEMA = "event_id long, video_id long, ts timestamp, note string"


def _deliver(spark, path, rows):
    df = spark.createDataFrame(rows, "event_id long, video_id long, s long, note string")
    df.select("event_id", "video_id", F.timestamp_seconds("s").alias("ts"), "note").coalesce(1).write.mode("append").parquet(path)


def test_copies_days_later_are_dropped_over_restarts(spark, scratch):
    path, out = f"{scratch}/input", f"{scratch}/out"
    day = 86_400
    first = [(1, 1, 10, "a"), (2, 1, 20, None), (3, 1, 30, ""), (4, None, 40, "1:x")]
    later = [(5, 1, 9 * day, "new"), (6, 1, 400 * day, "newer")]
    for rows in (first, later + first[:2], first[2:] + [(2, 1, 20, ""), (2, None, 20, None)] + later[:1]):  # runs go on from the checkpoint
        _deliver(spark, path, rows)
        events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
        with state_partitions(spark, 2):
            q = misc.dedup_forever(events).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{scratch}/ck")
            q.trigger(availableNow=True).start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("event_id", F.coalesce("video_id", F.lit(-1)), F.coalesce("note", F.lit("null"))).collect())
    assert got == sorted([(1, 1, "a"), (2, 1, "null"), (3, 1, ""), (4, -1, "1:x"), (5, 1, "new"), (6, 1, "newer"), (2, 1, ""), (2, -1, "null")])


def test_digests_tell_fields_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), ("abc", None), (None, "abc"), ("", "abc"), ("-", None), (None, "-"), (None, None), ("1:a", ""), ("", "1:a")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(misc.delivery_digest(df).alias("d")).distinct().count() == len(rows)
    assert misc.dedup_forever(df.union(df)).count() == len(rows)
