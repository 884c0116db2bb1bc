"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, partitions: int = 8, app: str = "vidpulse",
                  driver_memory: str = "8g", max_partition_bytes: str = "128m",
                  advisory_partition_bytes: str = "256m", rocksdb_state: bool = True,
                  extra: dict | None = None) -> SparkSession:
    """Session with the settings every job here assumes.

    * AQE on: runtime coalescing of small shuffle partitions, runtime
      broadcast of sides that turn out small, and skew-join splitting.
    * UTC session zone: event times are stored without zone.
    * UI off: no web server.
    On a cluster pass ``master=None`` and size ``partitions`` to the data
    (about 128-256 MB of shuffle data per partition); AQE coalesces toward
    ``advisory_partition_bytes`` and splits skewed partitions.  Input splits
    are ``max_partition_bytes`` (lower it for text columns that explode into
    many words per row).  ``rocksdb_state``: streaming state (per-video
    totals, open windows, dedup keys) lives in RocksDB off the JVM heap with
    changelog checkpoints, so state size is bounded by disk, not heap.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_bytes)
        .config("spark.sql.files.maxPartitionBytes", max_partition_bytes)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if rocksdb_state:
        b = b.config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        ).config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    This is the folder named by ``spark.checkpoint.dir``; driver and
    executors share it.  Only a local master may run without the setting:
    a fresh scratch folder is then registered with the SparkContext (the
    config itself cannot be changed at run time), and later calls reuse it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if d and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    if not d and not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="vidpulse-ckpt-"))
    return d.rstrip("/") if d else sc.getCheckpointDir().rstrip("/").removeprefix("file:")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder: several
    consumers read the same rows, and a lost executor reads them again
    instead of replaying the lineage.  Spark removes the files when the frame
    is no longer in use (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


@contextlib.contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Shuffle (and so state-store) partitions for streaming queries started
    inside the block: ``n``, or the cluster's parallelism, never more than
    the session's setting.  A stream fixes its state partitions when it
    first starts; a bounded replay does not need hundreds of state stores.
    The session value is restored afterwards."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    if n is None:
        try:
            n = spark.sparkContext.defaultParallelism
        except Exception:  # noqa: BLE001 - no SparkContext (e.g. Spark Connect)
            n = int(old)
    spark.conf.set("spark.sql.shuffle.partitions", str(max(1, min(int(old), n))))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
