"""Adaptive load shedding of comment sentences.

Per comment window, the total number of words over all videos is compared
with a capacity; above it each sentence is kept with probability
capacity / words.  The window totals are a grouped sum (one row per window)
joined back on ``window_start``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidpulse.functions.draw import hash_uniform, keep_probability, random_uniform
from vidpulse.functions.text import word_count
from vidpulse.operators.text import COMMENT_WINDOW, windowed
from vidpulse.schema import SENTIMENT_WORD_CAPACITY


def window_keep_probability(comments: DataFrame, capacity: int = SENTIMENT_WORD_CAPACITY,
                            length: str = COMMENT_WINDOW, text: str = "comment") -> DataFrame:
    """Output: window_start, words, prob."""
    w = windowed(comments.select("ts", word_count(F.col(text)).alias("_wc")), length)
    g = w.groupBy("window_start").agg(F.sum("_wc").cast("bigint").alias("words"))
    return g.select("window_start", "words", keep_probability(F.col("words"), capacity).alias("prob"))


def adaptive_sample(sentences: DataFrame, probs: DataFrame, length: str = COMMENT_WINDOW,
                    key: str = "video_id", draw: str = "hash", seed: int | None = None) -> DataFrame:
    """Keep a sentence when its draw u >= 1 - prob of its window.

    ``draw="hash"``: u from md5(video_id | ts | pos | sentence): each
    occurrence of a sentence has its own draw, the same on every run;
    ``draw="rand"``: Spark's ``rand``.
    The totals have one row per window, so their size is bounded by the
    time span / window length, not by the data volume; no hint is given:
    Spark's size threshold (or AQE at run time, on measured sizes) makes it
    a broadcast, and a shuffle join of a hot window is split by AQE's skew
    handling.
    """
    u = hash_uniform(F.col(key), F.col("ts"), F.col("pos"), F.col("sentence")) if draw == "hash" else random_uniform(seed)
    w = windowed(sentences, length)
    j = w.join(probs.select("window_start", "prob"), "window_start")
    return j.where(u >= F.lit(1.0) - F.col("prob")).drop("prob")


def sampled_counts(sampled: DataFrame, key: str = "video_id") -> DataFrame:
    return sampled.groupBy(key, "window_start").agg(F.count(F.lit(1)).alias("n"))
