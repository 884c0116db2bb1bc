"""Event sources: newline-delimited JSON files, Kafka topics, parquet tables.

A Kafka reader subscribes to the topics it is given and keeps the topic as a
column; each output of the application names only the topics it needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.schema import EVENT_SCHEMA, SECONDS_PER_SIM_UNIT, TOPIC_OF_TYPE
from vidpulse.sources.envelope import event_time, parse_events

ALL_TOPICS = list(TOPIC_OF_TYPE.values())


def read_event_lines(spark: SparkSession, path: str, streaming: bool = False, base: str = "1970-01-01 00:00:00",
                     max_files_per_trigger: int | None = None,
                     seconds_per_unit: float = SECONDS_PER_SIM_UNIT) -> DataFrame:
    """Event log lines (one JSON object per line) with a fixed schema.
    Lines that are no event are left out (``bad_record_count`` counts them)."""
    if streaming:
        r = spark.readStream.schema(EVENT_SCHEMA)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.json(path)
    else:
        df = spark.read.schema(EVENT_SCHEMA).option("mode", "PERMISSIVE").json(path)
    df = df.withColumn("ts", event_time(F.col("timestamp"), base, seconds_per_unit)).withColumn("event_id", content_id())
    return df.where(F.col("event_type").isNotNull() & F.col("video_id").isNotNull())


def read_raw_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """The lines themselves (``value``), for ``bad_record_count``."""
    return (spark.readStream if streaming else spark.read).text(path)


def content_id() -> Column:
    """``event_id`` when the line has one, else a 64-bit hash of the event's
    fields: deterministic across re-reads, and equal only for identical
    (re-delivered) events."""
    fields = [f.name for f in EVENT_SCHEMA.fields if f.name != "event_id"]
    return F.coalesce(F.col("event_id"), F.xxhash64(*fields))


def kafka_rows_to_events(raw: DataFrame, base: str = "1970-01-01 00:00:00",
                         seconds_per_unit: float = SECONDS_PER_SIM_UNIT) -> DataFrame:
    """Kafka rows (value, topic, partition, offset) -> parsed events.

    ``event_id`` falls back to a 64-bit hash of (topic, partition, offset),
    the message's position in the log, when the payload carries none (a
    re-delivered message keeps its id); the topic stays as a column.
    """
    rows = raw.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")
    parsed = parse_events(rows, "value", base, seconds_per_unit)
    fallback = F.xxhash64("topic", "partition", "offset")
    return parsed.withColumn("event_id", F.coalesce("event_id", fallback))


def read_kafka(spark: SparkSession, brokers: str, topics: Sequence[str] = ALL_TOPICS, streaming: bool = True,
               starting_offsets: str | None = None, max_offsets_per_trigger: int | None = None,
               min_partitions: int | None = None, base: str = "1970-01-01 00:00:00",
               seconds_per_unit: float = SECONDS_PER_SIM_UNIT) -> DataFrame:
    """Events of ``topics``; envelopes decoded and parsed.

    A stream starts at ``latest`` unless told otherwise, a batch read at
    ``earliest`` (it reads what the topics hold).

    ``max_offsets_per_trigger`` bounds a micro-batch (back-pressure under
    load spikes).  ``min_partitions`` lets Spark split the offset range of a
    hot topic partition over several tasks, so one busy partition is not
    read by a single task.  Needs the Kafka connector on the classpath.
    """
    r = (spark.readStream if streaming else spark.read).format("kafka").options(
        **kafka_options(brokers, topics, streaming, starting_offsets, max_offsets_per_trigger, min_partitions))
    return kafka_rows_to_events(r.load(), base, seconds_per_unit)


def kafka_options(brokers: str, topics: Sequence[str] = ALL_TOPICS, streaming: bool = True,
                  starting_offsets: str | None = None, max_offsets_per_trigger: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Reader options of ``read_kafka``."""
    out = {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics),
           "startingOffsets": starting_offsets or ("latest" if streaming else "earliest")}
    if streaming and max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        out["minPartitions"] = str(min_partitions)
    return out


def read_table_stream(spark: SparkSession, directory: str, table: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """One parquet table (a file or a folder of part files) as a file stream
    (tests, replay).  Without ``max_files_per_trigger`` one batch holds all
    files, so no row can be late against another file."""
    path = f"{directory.rstrip('/')}/{table}.parquet"
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(f"{path[:-1]}[t]")  # a file stream takes a single file only by a glob


def read_archive(spark: SparkSession, path: str, topics: Sequence[str] | None = None,
                 first_date: str | None = None, last_date: str | None = None) -> DataFrame:
    """Batch replay of the raw archive (parquet partitioned by topic and
    event_date).  Topic and date bounds prune partitions at listing time."""
    df = spark.read.parquet(path)
    if topics:
        df = df.where(F.col("topic").isin(list(topics)))
    if first_date:
        df = df.where(F.col("event_date") >= F.lit(first_date).cast("date"))
    if last_date:
        df = df.where(F.col("event_date") <= F.lit(last_date).cast("date"))
    return df
