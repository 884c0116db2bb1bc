"""Comment statistics of one batch of comments (a whole table or one
micro-batch): the per-window outputs of the serving tables, with load
shedding before the scoring step where the caller asks for it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.functions.draw import hash_uniform, keep_probability
from vidpulse.functions.text import token_array, word_array
from vidpulse.operators.text import StopWords
from vidpulse.operators import sampling, sentiment, text
from vidpulse.sources.fixtures import lexicon_of_words


def comment_histogram(comments: DataFrame, lexicon: DataFrame | None, capacity: int | None = None,
                      draw: str = "hash", length: str = text.COMMENT_WINDOW,
                      scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Sentiment class histogram per (video, window).

    Every sentence is scored.  Only a caller that sets ``capacity`` sheds
    load: above that many words per window a capacity/words share of the
    sentences is scored.

    ``lexicon=None`` uses the stand-in scores (``lexicon_of_words``) of the
    comments' own vocabulary (a fast letter-run pass; the sentence split
    is not repeated for it).
    """
    sentences = text.comment_sentences(comments)
    if capacity is not None:
        probs = sampling.window_keep_probability(comments, capacity, length)
        sentences = sampling.adaptive_sample(sentences, probs, length, draw=draw).drop("window_start")
    if lexicon is None and scorer is None:
        lexicon = lexicon_of_words(text.comment_words(comments))
    return sentiment.sentence_sentiment(sentences, lexicon, length, scorer=scorer)


def comment_sentiment(comments: DataFrame, lexicon: DataFrame | None, capacity: int | None = None,
                      draw: str = "hash", length: str = text.COMMENT_WINDOW,
                      scorer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Mean sentiment per (video, window); sheds only with a ``capacity``."""
    return sentiment.mean_sentiment(comment_histogram(comments, lexicon, capacity, draw, length, scorer))


# Additive per-batch outputs: (keys, summed columns).  Top words and mean
# sentiment are derived from the summed counts when the tables are read.
PARTIAL_TABLES = {
    "comment_sentiment": (["video_id", "window_start", "sentiment_class"], ["n"]),
    "comment_words": (["video_id", "window_start", "word"], ["n"]),
    "comment_tokens": (["video_id", "window_start"], ["n_sentences", "n_tokens"]),
    "comment_sentences": (["video_id", "window_start", "sentence"], ["n"]),
}


def comment_partials(comments: DataFrame, lexicon: DataFrame | None, stop_words: StopWords,
                     capacity: int | None = None, draw: str = "hash",
                     scorer: Callable[[Column], Column] | None = None) -> dict[str, DataFrame]:
    """Additive comment statistics of one batch (see ``PARTIAL_TABLES``)."""
    sentences = text.comment_sentences(comments)
    return {
        "comment_sentiment": comment_histogram(comments, lexicon, capacity, draw, scorer=scorer),
        "comment_words": text.word_counts(comments, stop_words),
        "comment_tokens": text.token_stats(sentences),
        "comment_sentences": text.windowed_sentence_counts(sentences),
    }


def shed_counted(per: DataFrame, capacity: int, key: str = "video_id") -> DataFrame:
    """Counted sentences (key, window_start, sentence, n) thinned to the
    window's keep probability: ``floor(n * prob + u)`` copies of each stay,
    u a hash draw, so the kept share meets the capacity however the copies
    are spread.  A window's load is the sum over its sentences (a comment's
    words are its sentences' words)."""
    words = F.size(word_array(F.col("sentence"))) * F.col("n")
    probs = per.groupBy("window_start").agg(F.sum(words).cast("bigint").alias("words")).select(
        "window_start", keep_probability(F.col("words"), capacity).alias("prob"))
    u = hash_uniform(F.col(key), F.col("window_start"), F.col("sentence"))
    kept = per.join(probs, "window_start").withColumn("n", F.floor(F.col("n") * F.col("prob") + u).cast("bigint"))
    return kept.where("n > 0").drop("prob")


def partials_from_sentence_counts(per: DataFrame, lexicon: DataFrame | None, stop_words: StopWords,
                                  capacity: int | None = None, key: str = "video_id",
                                  scorer: Callable[[Column], Column] | None = None) -> dict[str, DataFrame]:
    """The additive comment outputs from complete windows given as sentence
    counts (key, window_start, sentence, n)."""
    tokens = per.groupBy(key, "window_start").agg(
        F.sum("n").cast("bigint").alias("n_sentences"),
        F.sum(F.size(token_array(F.col("sentence"))) * F.col("n")).cast("bigint").alias("n_tokens"),
    )
    kept = per if capacity is None else shed_counted(per, capacity, key)
    return {
        "comment_sentiment": sentiment.sentiment_histogram(kept, lexicon, key, scorer),
        "comment_words": text.word_counts_from_sentences(per, stop_words, key),
        "comment_tokens": tokens,
        "comment_sentences": per.select(key, "window_start", "sentence", "n"),
    }
