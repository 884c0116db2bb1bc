"""Sinks: keyed upsert (serving tables), archive, topic routing, text, console.

The keyed upsert replaces a key-value store written from the driver: each
micro-batch is written by the executors as its own parquet folder
``batch=<id>``; readers keep the newest row per key.  Re-running a batch id
(at-least-once delivery, restart) overwrites the same folder, so the sink is
idempotent.  Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COL = "batch"


class UpsertTable:
    """Last-write-wins table keyed by ``keys`` on plain parquet.

    Layout: one folder ``<path>/batch=<id>`` per micro-batch; a replayed
    batch id overwrites its own folder and nothing else, so a reader between
    any two steps of a write sees every earlier batch whole.  A batch spans a
    short time, so ``read(since=...)`` skips older files by their statistics.
    For long-running streams see ``levels.LevelledTable``.
    """

    def __init__(self, path: str, keys: Sequence[str], date_col: str = "window_start"):
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.date_col = date_col

    # writing --------------------------------------------------------------
    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/{BATCH_COL}={int(batch_id)}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:  # foreachBatch hook
        self.write_batch(batch, batch_id)

    # reading --------------------------------------------------------------
    def _raw(self, spark: SparkSession, since: str | None, only: DataFrame | None) -> DataFrame:
        return self._narrowed(spark.read.parquet(self.path), since, only)

    def _narrowed(self, raw: DataFrame, since: str | None, only: DataFrame | None) -> DataFrame:
        if since and self.date_col in raw.columns:
            raw = raw.where(F.col(self.date_col) >= F.lit(since).cast(raw.schema[self.date_col].dataType))
        return raw if only is None else raw.join(only, [c for c in only.columns if c in self.keys], "left_semi")

    def _fold(self, raw: DataFrame) -> DataFrame:
        """Newest row per key (max batch id).  ``max_by`` is a partial
        aggregate, so a key updated in many batches is reduced map-side."""
        values = [c for c in raw.columns if c not in self.keys and c != BATCH_COL]
        g = raw.groupBy(*self.keys).agg(F.max_by(F.struct(*values), BATCH_COL).alias("_v"))
        return g.select(*self.keys, *[F.col(f"_v.{c}").alias(c) for c in values])

    def read(self, spark: SparkSession, since: str | None = None, only: DataFrame | None = None) -> DataFrame:
        """Newest rows.  ``since``: dates from this day on; ``only``: keys
        (some of ``keys``) to read, applied before rows are folded."""
        return self._fold(self._raw(spark, since, only))

    def compact(self, spark: SparkSession, path: str) -> UpsertTable:
        """The current snapshot as a new table at ``path`` (batch 0)."""
        snap = UpsertTable(path, self.keys, self.date_col)
        snap.write_batch(self.read(spark), 0)
        return snap


class AdditiveTable(UpsertTable):
    """Table of per-batch partial counts: each batch id owns one folder
    (idempotent overwrite); readers sum ``value_cols`` per key over all
    batches.  For window statistics whose event-time window can straddle
    micro-batches (a last-write-wins row would keep only the last part)."""

    def __init__(self, path: str, keys: Sequence[str], value_cols: Sequence[str]):
        super().__init__(path, keys)
        self.value_cols = list(value_cols)

    def _fold(self, raw: DataFrame) -> DataFrame:
        return raw.groupBy(*self.keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in self.value_cols])


def upsert_sink(df: DataFrame, table: UpsertTable | Callable, checkpoint: str, trigger: dict | None = None,
                name: str | None = None):
    """Start a streaming query that upserts every batch into ``table``
    (update output mode: only changed keys are written)."""
    w = df.writeStream.outputMode("update").foreachBatch(table).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
    return w.start()


def table_sink(df: DataFrame, fmt: str, options: dict, checkpoint: str, mode: str = "update",
               trigger: dict | None = None, save_mode: str | None = None):
    """Write every micro-batch through a DataFrame writer format, so that a
    replayed batch changes nothing.

    File formats (``path`` option): each batch owns the folder
    ``<path>/batch=<id>``.  A connector of a wide-column store (keyspace and
    table options, jar on the classpath) must upsert by primary key; name
    the mode in which it does as ``save_mode``.
    """
    if "path" not in options and save_mode is None:
        raise ValueError("name the save_mode in which the connector upserts by key")

    def write(batch: DataFrame, batch_id: int) -> None:
        own = {"path": f"{options['path']}/{BATCH_COL}={int(batch_id)}"} if "path" in options else {}
        batch.write.format(fmt).options(**{**options, **own}).mode(save_mode or "overwrite").save()

    w = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def archive_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Raw event archive: parquet partitioned by topic and event date."""
    out = df.withColumn("event_date", F.to_date("ts"))
    w = (
        out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy("topic", "event_date").outputMode("append")
    )
    return w.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def write_archive(df: DataFrame, path: str) -> None:
    """Batch form of the archive (replay input for batch jobs)."""
    df.withColumn("event_date", F.to_date("ts")).write.mode("append").partitionBy("topic", "event_date").parquet(path)


def routed_sink(df: DataFrame, brokers: str | None, path: str | None, checkpoint: str, trigger: dict | None = None):
    """Per-row topic routing.  With ``brokers`` the rows go to Kafka
    (columns topic, key, value); otherwise to files partitioned by topic."""
    out = df.select("topic", "key", "value")
    if brokers:
        w = out.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
    else:
        w = out.writeStream.format("json").option("path", path).partitionBy("topic")
    w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "1 second"})).start()


def text_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "json", trigger: dict | None = None):
    """Per-batch text output of windowed counts (json lines)."""
    w = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return w.trigger(**(trigger or {"processingTime": "3 seconds"})).start()


def console_sink(df: DataFrame, mode: str = "update", trigger: dict | None = None):
    w = df.writeStream.format("console").outputMode(mode).option("truncate", "false")
    return w.trigger(**(trigger or {"processingTime": "3 seconds"})).start()
