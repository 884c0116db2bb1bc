"""Route events to per-type topics (exact ``event_type`` match)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.schema import TOPIC_OF_TYPE


def topic_of(event_type: Column) -> Column:
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(TOPIC_OF_TYPE.items())])
    return lookup[event_type]


def route_events(df: DataFrame) -> DataFrame:
    """Add ``topic``; unknown types get null and are dropped."""
    return df.withColumn("topic", topic_of(F.col("event_type"))).where(F.col("topic").isNotNull())


def routed_counts(df: DataFrame) -> DataFrame:
    return route_events(df).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def with_comments(events: DataFrame, comments: DataFrame) -> DataFrame:
    """Union plain events and comment rows into one event frame."""
    c = comments.select(
        F.lit(None).cast("bigint").alias("event_id"), "ts", F.lit(None).cast("bigint").alias("user_id"),
        "video_id", F.lit("comment").alias("event_type"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        "comment",
    )
    e = events.withColumn("comment", F.lit(None).cast("string"))
    return e.unionByName(c)


def comments_of(events: DataFrame) -> DataFrame:
    """Comment events that carry text (the field is absent on other types)."""
    c = F.col("comment")
    return events.where((F.col("event_type") == "comment") & c.isNotNull() & (c != ""))
