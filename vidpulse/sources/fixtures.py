"""Views over the driver's test tables in the event model.

``lv_events``  events -> (event_id, ts, user_id, video_id, event_type, latitude, longitude)
``lv_comments`` conversations -> (video_id, ts, comment)
``lv_stop_words`` the fixed stop list
``lv_lexicon`` a computed word score table over the comment vocabulary

The DuckDB twins of these definitions live in ``vidpulse.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vidpulse.functions.text import word_array
from vidpulse.schema import STOP_WORDS

COMMENT_EPOCH = "2024-01-01 00:00:00"  # zone-less wall time
COMMENT_TURN_SECONDS = 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Generic event type behind each video event type.
RAW_TYPE_OF = {
    "start_video": "signup",
    "end_video": "signup",
    "play": "view",
    "leave": "error",
    "like": "click",
    "dislike": "purchase",
}


def events_as_video_events(events: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Map the generic ``events`` table onto video events.

    signup -> start_video (even id) / end_video (odd id), view -> play,
    error -> leave, click -> like, purchase -> dislike.  Location comes
    from ``props.k``.  Works on batch and streaming frames.

    ``types``: the video event types the caller needs.  The matching raw
    types are filtered before the mapping, so the predicate reaches the
    parquet scan (a filter on the mapped CASE column cannot be pushed).
    """
    wanted = list(RAW_TYPE_OF) if types is None else [t for t in RAW_TYPE_OF if t in set(types)]
    if types is not None:
        events = events.where(F.col("event_type").isin(sorted({RAW_TYPE_OF[t] for t in wanted})))
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    # only the branches of the requested types, so unused inputs (event_id for
    # the start/end split) are pruned from the scan
    even = F.coalesce(F.col("event_id") % 2 == 0, F.lit(False))
    branches = {
        "start_video": (kind == "signup") & even,
        "end_video": (kind == "signup") & ~even,
        "play": kind == "view",
        "leave": kind == "error",
        "like": kind == "click",
        "dislike": kind == "purchase",
    }
    mapped = None
    for t in wanted:
        mapped = F.when(branches[t], F.lit(t)) if mapped is None else mapped.when(branches[t], F.lit(t))
    return events.select(
        "event_id",
        "ts",
        (F.col("event_id") % 997).alias("user_id"),
        F.col("user_id").alias("video_id"),
        mapped.alias("event_type"),
        (F.lit(24) + k.cast("double") * 26 / 100).alias("latitude"),
        (F.lit(-124) + ((k.cast("bigint") * 37) % 100).cast("double") * 58 / 100).alias("longitude"),
    )


def lv_events(spark: SparkSession, sf_dir: str, types: Sequence[str] | None = None) -> DataFrame:
    return events_as_video_events(_table(spark, sf_dir, "events"), types)


def comment_time(turn: Column) -> Column:
    return F.lit(COMMENT_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        secs=(turn * COMMENT_TURN_SECONDS).cast("decimal(18,6)")
    )


def conversations_as_comments(c: DataFrame) -> DataFrame:
    """conversations -> (video_id, ts, comment); batch or streaming."""
    return c.select(
        F.col("conv_id").alias("video_id"),
        comment_time(F.col("turn")).alias("ts"),
        F.col("text").alias("comment"),
    )


def lv_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations_as_comments(_table(spark, sf_dir, "conversations"))


#: Turns that a conversation's comment numbers leave room for.
TURNS = 1 << 20


def numbered_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, comment): every comment with a number of its own."""
    c = _table(spark, sf_dir, "conversations")
    return c.select((F.col("conv_id") * TURNS + F.col("turn")).alias("doc"), F.col("text").alias("comment"))


def documents_as_comments(d: DataFrame) -> DataFrame:
    """documents -> (video_id, ts, comment): every document is one long
    comment of its own stream, all in the first comment window (volume
    fixture for the text operators)."""
    return d.select(F.col("doc_id").alias("video_id"), F.lit(COMMENT_EPOCH).cast("timestamp_ntz").alias("ts"),
                    F.col("text").alias("comment"))


def lv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_as_comments(_table(spark, sf_dir, "documents"))


def lv_stop_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOP_WORDS], T.StructType([T.StructField("word", T.StringType())]))


def derive_lexicon(comments: DataFrame, text_col: str = "comment") -> DataFrame:
    """Word score table over the comment vocabulary: score = len % 5 - 2.

    Stand-in for a real sentiment lexicon (any (word, score) table can be
    passed to the sentiment operators instead).
    """
    words = comments.select(F.explode(word_array(F.col(text_col))).alias("word")).distinct()
    return words.select("word", (F.length("word") % 5 - 2).cast("bigint").alias("score"))


def lexicon_of_words(words: DataFrame) -> DataFrame:
    """The same score table from a frame that already has a ``word`` column."""
    return words.select("word").distinct().select("word", (F.length("word") % 5 - 2).cast("bigint").alias("score"))


def lv_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_lexicon(lv_comments(spark, sf_dir))


def register_fixture_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Temp views ``lv_events``, ``lv_comments``, ``lv_documents`` and
    ``lv_stop_words`` for ``spark.sql``."""
    views = {
        "lv_events": lv_events(spark, sf_dir),
        "lv_comments": lv_comments(spark, sf_dir),
        "lv_documents": lv_documents(spark, sf_dir),
        "lv_stop_words": lv_stop_words(spark),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
