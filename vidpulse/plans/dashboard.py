"""The map dashboard as one DataFrame plan.

Per located video: concurrent viewers, newest like / dislike window counts,
top words and mean sentiment of its newest comment window, marker geometry
and colour.  Every input is one row per video, so each join is a per-video
equi-join (shuffle or AQE broadcast), replacing a per-key lookup loop.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.functions.geo import color_ramp, corner_columns, marker_size, popup_labels
from vidpulse.functions.text import word_array
from vidpulse.operators.counts import window_start_col
from vidpulse.operators.sentiment import mean_sentiment, sentiment_histogram
from vidpulse.operators.text import (
    StopWords,
    COMMENT_WINDOW,
    comment_sentences,
    newest_window_comments,
    top_words,
    top_words_text,
    windowed_sentence_counts,
    word_counts_from_sentences,
)
from vidpulse.operators.viewers import concurrent_from_totals
from vidpulse.session import checkpointed
from vidpulse.sources.fixtures import lexicon_of_words

KEY = "video_id"


@dataclass
class DashboardInputs:
    """One row per video each."""

    videos: DataFrame     # video_id, plays, leaves, views, out_of_order, latitude, longitude, likes, dislikes
    words: DataFrame      # video_id, words (text)
    sentiment: DataFrame  # video_id, score


def video_summary(events: DataFrame, reaction_window: str, key: str = KEY) -> DataFrame:
    """Every per-video event fact of the map from ONE scan of the events.

    Level 1, per (video, reaction window): plays, leaves, likes, dislikes
    and the newest start record.  Level 2, per video: total plays and
    leaves, the like / dislike count of the newest window that had any
    (a last-write-wins store keeps exactly that), the newest start.
    Both levels are hash aggregates with map-side partial aggregation, so a
    hot video costs one partial row per task, and the table is read once
    instead of once per fact.  Videos need a play (concurrent viewers) and
    a start record (location).
    """
    t = F.col("event_type")
    rec = F.struct("ts", "event_id", "latitude", "longitude")
    per_window = events.where(t.isin("play", "leave", "like", "dislike", "start_video")).groupBy(
        key, window_start_col(events, F.window("ts", reaction_window).start).alias("window_start")
    ).agg(
        F.count_if(t == "play").alias("plays"),
        F.count_if(t == "leave").alias("leaves"),
        F.count_if(t == "like").alias("likes"),
        F.count_if(t == "dislike").alias("dislikes"),
        F.max(F.when(t == "start_video", rec)).alias("start"),
    )
    def newest_nonzero(c: str):
        return F.max_by(c, F.when(F.col(c) > 0, F.col("window_start")))

    per_video = per_window.groupBy(key).agg(
        F.sum("plays").cast("bigint").alias("plays"),
        F.sum("leaves").cast("bigint").alias("leaves"),
        newest_nonzero("likes").alias("likes"),
        newest_nonzero("dislikes").alias("dislikes"),
        F.max("start").alias("start"),
    )
    located = per_video.where((F.col("plays") >= 1) & F.col("start").isNotNull())
    views = F.col("plays") - F.col("leaves")
    return located.select(
        key, "plays", "leaves", views.alias("views"), (views < 0).alias("out_of_order"),
        F.col("start.latitude").alias("latitude"), F.col("start.longitude").alias("longitude"),
        F.coalesce("likes", F.lit(0)).cast("bigint").alias("likes"),
        F.coalesce("dislikes", F.lit(0)).cast("bigint").alias("dislikes"),
    )


def videos_from_serving(plays: DataFrame, leaves: DataFrame, starts: DataFrame, likes: DataFrame,
                        dislikes: DataFrame, key: str = KEY) -> DataFrame:
    """The same per-video row from the live serving snapshots (one row per
    key each): plays inner-join start location, left-join leaves, likes and
    dislikes (missing = 0)."""
    v = concurrent_from_totals(plays, leaves, key).join(starts.select(key, "latitude", "longitude"), key)
    for name, tbl in (("likes", likes), ("dislikes", dislikes)):
        v = v.join(tbl.select(key, F.col("n").alias(name)), key, "left").withColumn(
            name, F.coalesce(name, F.lit(0)).cast("bigint"))
    return v


def comment_facts(comments: DataFrame, stop_words: StopWords, lexicon: DataFrame | None, k: int = 5,
                  length: str = COMMENT_WINDOW,
                  scorer: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Per video: top-word text and mean sentiment of its newest comment
    window (the newest that had sentences; "[]" when all its words were stop
    words).

    Only that window's comments are split into sentences and words; older
    ones are filtered by their window first.  Words, the derived lexicon
    (when ``lexicon`` is None) and sentiment read one checkpointed
    (video, window, sentence) table.
    """
    per = checkpointed(windowed_sentence_counts(comment_sentences(newest_window_comments(comments, length)), length))
    newest = per.groupBy(KEY).agg(F.max("window_start").alias("window_start"))
    text = top_words_text(top_words(word_counts_from_sentences(per, stop_words), k))
    words = newest.join(text, [KEY, "window_start"], "left").select(
        KEY, F.coalesce("words", F.lit("[]")).alias("words"))
    if lexicon is None and scorer is None:
        lexicon = lexicon_of_words(per.select(F.explode(word_array(F.col("sentence"))).alias("word")))
    sentiment = mean_sentiment(sentiment_histogram(per, lexicon, scorer=scorer)).select(KEY, "score")
    return words, sentiment


def dashboard_inputs(events: DataFrame, comments: DataFrame, stop_words: StopWords, lexicon: DataFrame | None,
                     reaction_window: str, comment_window: str = COMMENT_WINDOW, k: int = 5) -> DashboardInputs:
    """``lexicon=None``: score words with the lexicon derived from the
    comment vocabulary itself (test stand-in)."""
    words, sentiment = comment_facts(comments, stop_words, lexicon, k, comment_window)
    return DashboardInputs(videos=video_summary(events, reaction_window), words=words, sentiment=sentiment)


def _joined(inp: DashboardInputs) -> DataFrame:
    v = inp.videos.join(inp.words, KEY, "left")
    return v.join(inp.sentiment.select(KEY, F.col("score").alias("sentiment")), KEY, "left")


def map_features(inp: DashboardInputs) -> DataFrame:
    """One row per located, played video with every map attribute."""
    v = _joined(inp)
    size = marker_size(F.col("views"))
    return v.select(
        KEY,
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        "views", "plays", "likes", "dislikes",
        "words",
        "sentiment",
        size.alias("size"),
        *corner_columns(F.col("latitude"), F.col("longitude"), size),
        color_ramp(F.col("likes")).alias("color"),
    )


def popup_text(inp: DashboardInputs) -> DataFrame:
    v = _joined(inp)
    return v.select(KEY, *popup_labels(F.col("views"), F.col("plays"), F.col("likes"), F.col("dislikes"),
                                       F.col("words"), F.col("sentiment")))
