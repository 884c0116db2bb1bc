"""Per-record running counts on a stream, with keyed state and event-time timers.

A record's running count is known once no earlier record can come: records
wait in keyed state until the watermark passes their time, are then released
in (time, id) order and counted.  So the answer does not depend on the order
of arrival within the watermark delay, and equals the batch prefix sums.

A state key is a bucket of videos (``BUCKETS``), as each call of a state costs
milliseconds however few records it is for: the calls of a micro-batch do not
grow with the videos.  State per bucket is the counts of its videos, as one row
of arrays, and the records that wait, as a row of arrays per micro-batch
(``CHUNK`` records at most).  A record that comes more than ``idle`` of event
time after the one before it counts from 0, so a video that is idle for so long
needs no state: an event-time timer removes it.  (Spark's time-to-live goes by
processing time, which a replay would not repeat.)  Without ``idle`` the count
stays.

An initial state (video, count) is read once, when the stream first starts,
and is partitioned like the state.  All records of one bucket go through one
task of a micro-batch, in event order; for backfills use the batch operators
(``viewers.running_count``), which split hot videos.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vidpulse.functions.time import ntz_to_instant
from vidpulse.session import scratch_path, state_partitions
from vidpulse.sources.fixtures import lv_events
from vidpulse.streaming.jobs import _finish, with_event_time
from vidpulse.streaming.sinks import UpsertTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_KEY = ["known", "key"]
_OUT = [*_KEY, "event_id", "running"]
_COUNT = [*_KEY, "running", "newest_us"]
_WAITING = [*_KEY, "us", "event_id", "delta"]
#: State keys over which the videos are dealt; fixed when a stream first starts.
BUCKETS = 256
#: Records in one row of the waiting list.
CHUNK = 1 << 16


class RunningSum(StatefulProcessor):
    """Sum of ``delta`` per key after each record, in (``us``, ``event_id``)
    order, for the keys (of type ``kind``) of a bucket."""

    def __init__(self, idle_ms: int | None = None, kind: str = "bigint") -> None:
        self.idle_ms, self.kind = idle_ms, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        keys = f"known array<boolean>, key array<{self.kind}>"
        self.count = handle.getValueState("count", f"{keys}, running array<long>, newest_us array<long>")
        self.waiting = handle.getListState("waiting", f"{keys}, us array<long>, event_id array<long>, delta array<long>")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:  # noqa: N802,N803
        seeds = [initialState.assign(newest_us=0), *([self._counts()] if self.count.exists() else [])]
        self._store(pd.concat(seeds).groupby(_KEY, as_index=False)[["running", "newest_us"]].sum())

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        oldest = None
        for part in _joined(rows):
            self.waiting.appendList(_arrays(part))
            oldest = int(part["us"].min()) if oldest is None else min(oldest, int(part["us"].min()))
        if oldest is not None:
            self._wake(oldest)
        yield pd.DataFrame(columns=_OUT)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = _frame(self.waiting.get() if self.waiting.exists() else [], _WAITING)
        is_due = held["us"].to_numpy(dtype="int64") <= passed
        counts = self._counts()
        out = pd.DataFrame(columns=_OUT)
        if is_due.any():
            out, counts = self._count_on(held[is_due], counts)
            rest = held[~is_due]
            if len(rest):
                self.waiting.put(_arrays(rest))
                self._wake(int(rest["us"].min()))
            else:
                self.waiting.clear()
        if self.idle_ms is not None:
            counts = counts[~self._idle(counts["newest_us"].to_numpy(dtype="int64"), passed)]
            if len(timed := counts.loc[counts["newest_us"] > 0, "newest_us"]):
                self.handle.registerTimer(-(-int(timed.min()) // 1000) + self.idle_ms)
        if is_due.any() or self.idle_ms is not None:
            self._store(counts)
        yield out

    def _count_on(self, due: pd.DataFrame, counts: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The due records with their running sums, and the counts after them."""
        due = due.sort_values(_WAITING, ignore_index=True)
        due = due.merge(counts, how="left", on=_KEY) if len(counts) else due.assign(running=0, newest_us=0)
        us, delta = due["us"].to_numpy(dtype="int64"), due["delta"].to_numpy(dtype="int64")
        first = ~due.duplicated(_KEY).to_numpy()
        before = np.where(first, due["newest_us"].fillna(0).to_numpy(dtype="int64"), np.concatenate([[0], us[:-1]]))
        again = self._idle(before, us - 1)
        step = delta + np.where(first & ~again, due["running"].fillna(0).to_numpy(dtype="int64"), 0)
        total, at = np.cumsum(step), np.flatnonzero(first | again)
        due["running"] = total - np.repeat(total[at] - step[at], np.diff(np.append(at, len(due))))
        due["newest_us"] = us
        after = due.drop_duplicates(_KEY, keep="last")[_COUNT]
        return due[_OUT], pd.concat([counts, after]).drop_duplicates(_KEY, keep="last", ignore_index=True) if len(counts) else after

    def _counts(self) -> pd.DataFrame:
        return _frame([self.count.get()] if self.count.exists() else [], _COUNT)

    def _store(self, counts: pd.DataFrame) -> None:
        if len(counts):
            self.count.update(tuple(counts[c].tolist() for c in _COUNT))
        else:
            self.count.clear()

    def _idle(self, newest: np.ndarray, upto: np.ndarray | int) -> np.ndarray:
        """Which videos, their newest record being of ``newest``, have none for
        the idle time that ends at ``upto`` (a seed alone is never idle)."""
        if self.idle_ms is None:
            return np.zeros(len(newest), dtype=bool)
        return (newest > 0) & (newest + self.idle_ms * 1000 <= upto)

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def close(self) -> None:
        pass


def _joined(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts with at least ``CHUNK`` records but for the last; rows without id
    only say how far time is."""
    held, size = [], 0
    for part in rows:
        part = part.loc[part["has_id"], _WAITING]
        if part["us"].isna().any():
            raise ValueError("a record without time has no place in a running count")
        held.append(part)
        size += len(part)
        if size >= CHUNK:
            yield pd.concat(held)
            held, size = [], 0
    if size:
        yield pd.concat(held)


def _arrays(records: pd.DataFrame) -> list[tuple]:
    """Records as rows of arrays for the state."""
    return [tuple(records[c].iloc[at : at + CHUNK].tolist() for c in _WAITING) for at in range(0, len(records), CHUNK)]


def _frame(stored: Iterable[tuple], names: list[str]) -> pd.DataFrame:
    """Rows of arrays of the state as one frame."""
    parts = [pd.DataFrame(dict(zip(names, row))) for row in stored]
    return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({c: np.array([], dtype="int64") for c in names})


def running_stream(events: DataFrame, delta: Column, watermark: str, key: str = "video_id", seed: DataFrame | None = None,
                   idle_ms: int | None = None, out: str = "running", buckets: int = BUCKETS) -> DataFrame:
    """(key, event_id, ``out``) per record, released as the watermark passes
    it.  ``events``: event_id, key, ts; ``seed``: (key, running) to go on from."""
    timed = with_event_time(events, watermark)
    rows = timed.select(*_keyed(events, key), "ts", F.unix_micros("ts").alias("us"), F.col("event_id").isNotNull().alias("has_id"),
                        F.coalesce("event_id", F.lit(0)).cast("bigint").alias("event_id"), delta.cast("bigint").alias("delta"))
    start = None if seed is None else _bucketed(
        seed.select(*_keyed(seed, key), F.coalesce("running", F.lit(0)).cast("bigint").alias("running")), buckets).groupBy("bucket")
    kind = rows.schema["key"].dataType.simpleString()
    counted = _bucketed(rows, buckets).groupBy("bucket").transformWithStateInPandas(
        RunningSum(idle_ms, kind), f"known boolean, key {kind}, event_id long, running long", "Append", "EventTime", initialState=start)
    return counted.select("event_id", F.when(F.col("known"), F.col("key")).alias(key), F.col("running").alias(out))


def _bucketed(keyed: DataFrame, buckets: int) -> DataFrame:
    return keyed.withColumn("bucket", F.pmod(F.xxhash64(*_KEY), F.lit(buckets)).cast("int"))


def _keyed(df: DataFrame, key: str) -> list[Column]:
    """A key that may be null as two columns that are not: pandas groups mix
    up null keys with their neighbours."""
    instead = F.lit("0").cast(df.schema[key].dataType)
    return [F.col(key).isNotNull().alias("known"), F.coalesce(F.col(key), instead).alias("key")]


def running_count_stream(events: DataFrame, event_type: str, watermark: str, seed: DataFrame | None = None, idle_ms: int | None = None) -> DataFrame:
    """Running count of one event type per video, a row per record."""
    own = events.where((F.col("event_type") == event_type) | F.col("event_id").isNull())
    return running_stream(own, F.lit(1), watermark, seed=seed, idle_ms=idle_ms)


def viewer_timeline_stream(events: DataFrame, watermark: str, seed: DataFrame | None = None, idle_ms: int | None = None) -> DataFrame:
    """Concurrent viewers after each play and leave, a row per record."""
    own = events.where(F.col("event_type").isin("play", "leave") | F.col("event_id").isNull())
    return running_stream(own, F.when(F.col("event_type") == "play", 1).otherwise(-1), watermark, seed=seed, idle_ms=idle_ms, out="viewers")


@contextlib.contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which keyed state
    needs; the session's value is restored afterwards."""
    old = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, old)


def start_running(counted: DataFrame, table: UpsertTable, checkpoint: str, trigger: dict | None = None):
    """Start a query that keeps the released records in ``table`` (by event id)."""
    w = counted.writeStream.outputMode("append").foreachBatch(table).option("checkpointLocation", checkpoint)
    with keyed_state(counted.sparkSession):
        return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def disordered_input(events: DataFrame, path: str, files: int) -> tuple[DataFrame, str]:
    """``events`` written as ``files`` files in no order of time and streamed
    back one file a micro-batch, then a mark of time that lets the last
    records go.  Returns the stream and the watermark delay that covers the
    disorder (the span of the input)."""
    events = events.withColumn("ts", ntz_to_instant(F.col("ts"))) if dict(events.dtypes)["ts"] == "timestamp_ntz" else events
    spark = events.sparkSession
    events.repartition(files, F.xxhash64("event_id")).write.parquet(path)
    span = events.agg(F.unix_seconds(F.min("ts")).alias("a"), F.unix_seconds(F.max("ts")).alias("b")).first()
    first, last = (span["a"], span["b"]) if span["a"] is not None else (0, 0)
    delay = last - first + 1
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema.fields if f.name != "ts"]
    mark = spark.range(1).select(*empty, F.timestamp_seconds(F.lit(last + delay + 2)).alias("ts")).select(*events.columns)
    mark.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path), f"{delay} seconds"


def _run_once(events: DataFrame, counted, name: str) -> DataFrame:
    spark = events.sparkSession
    root = scratch_path(spark, name)
    stream, delay = disordered_input(events, f"{root}/input", 4)
    table = UpsertTable(f"{root}/table", ["event_id"])
    with state_partitions(spark):
        _finish(start_running(counted(stream, delay), table, f"{root}/checkpoint", {"availableNow": True}))
    return table.read(spark)


def run_play_count_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running plays of the whole table, streamed in no order of time."""
    plays = lv_events(spark, sf_dir, ["play"]).select("event_id", "video_id", "event_type", "ts")
    return _run_once(plays, lambda s, delay: running_count_stream(s, "play", delay), "stream-plays").select("event_id", "video_id", "running")


def run_viewer_timeline_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running viewers of the whole table, streamed in no order of time."""
    moves = lv_events(spark, sf_dir, ["play", "leave"]).select("event_id", "video_id", "event_type", "ts")
    return _run_once(moves, viewer_timeline_stream, "stream-viewers").select("event_id", "video_id", "viewers")
