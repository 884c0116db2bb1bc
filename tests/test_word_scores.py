"""Word scores of sentences by blocks, and the cleaning of comments."""

import random

from pyspark.sql import functions as F

from vidpulse.functions.text import clean_comment, has_content, word_array
from vidpulse.operators import sentiment, text


def test_cleaning_equals_replacing_runs(spark):
    rng = random.Random(3)
    parts = ["a", "B", "?", ".", "!", " ", "\n", "1", "é", "\U0001f600", "ſ", "K", "\x00", "ab c"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(7))),) for _ in range(5000)] + [(None,)]
    df = spark.createDataFrame(rows, "c string")
    want = F.regexp_replace("c", "[^A-Za-z?!.]+", " ")
    assert df.where(~clean_comment(F.col("c")).eqNullSafe(want)).count() == 0
    assert df.where(~has_content(F.col("c")).eqNullSafe(F.trim(want) != "")).count() == 0


def test_a_comment_is_cleaned_once(spark):
    df = spark.createDataFrame([(1, 0, "Good. Bad")], "video_id long, s long, comment string").withColumn("ts", F.timestamp_seconds("s"))
    plan = text.comment_sentences(df)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan
    assert plan.count("array_join") == 1  # not once more to see that it is not blank


def _case(spark, lexicon_type="long"):
    rng = random.Random(7)
    words = ["good", "BAD", "Fine", "x", "unknown", "the", "nul", "K", "é"]
    rows = [(rng.choice([1, 2, None]), 0, k, " ".join(rng.choice(words) for _ in range(rng.randrange(9)))) for k in range(700)]
    rows += [(None, 0, 700, None), (3, 0, 701, ""), (3, 0, 702, "? !"), (3, 0, 703, "good " * 3000)]
    df = spark.createDataFrame(rows, "video_id long, s long, id long, sentence string").withColumn("ts", F.timestamp_seconds("s"))
    scores = [("good", 3), ("bad", -4), ("fine", 1), ("the", 0), ("the", 1), ("nul", None), ("other", 9)]
    return df.repartition(3), spark.createDataFrame(scores, "word string, score long").select("word", F.col("score").cast(lexicon_type))


def _brute(df, lexicon):
    words = df.select("id", F.explode(word_array(F.col("sentence"))).alias("word")).join(lexicon, "word")
    sums = words.groupBy("id").agg(F.sum("score").alias("_s"), F.count("score").alias("_c"))
    return {r["id"]: (r["_s"] if r["_c"] else None, r["_c"]) for r in df.select("id").join(sums, "id", "left").fillna(0, ["_c"]).collect()}


def test_word_scores_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "BLOCK_BYTES", 2000)
    for kind in ("long", "double"):
        df, lexicon = _case(spark, kind)
        got = sentiment.word_scores(df, lexicon, ["id", "video_id"])
        assert dict(got.dtypes)["_s"] == {"long": "bigint", "double": "double"}[kind]
        assert {r["id"]: (r["_s"], r["_c"]) for r in got.collect()} == _brute(df, lexicon)


def test_no_sentences_and_no_lexicon(spark):
    df, lexicon = _case(spark)
    assert sentiment.word_scores(df.where("id < 0"), lexicon, ["id"]).count() == 0
    assert {r["_c"] for r in sentiment.word_scores(df, lexicon.where("word = ''"), ["id"]).collect()} == {0}


def test_only_a_blocks_distinct_words_meet_the_lexicon(spark):
    """A row a word occurrence went through two shuffles before."""
    df, lexicon = _case(spark)
    hist = sentiment.sentence_sentiment(df.select("video_id", "ts", "sentence"), lexicon)
    plan = hist._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    rows = sum(r["n"] for r in hist.collect())
    assert rows == df.count()
    scored = sentiment.scored_sentences(df, lexicon)
    assert "Generate" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.columns == [*df.columns, "sentiment_class"] and scored.count() == rows
