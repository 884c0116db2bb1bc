"""Shared helpers: word pattern, scratch tables, skew-proof lookups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words in every text contract (ASCII only).
SPACE = r"[\x20\x09-\x0D]"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new location under the folder that ``spark.checkpoint.dir`` names.

    Driver and executors share that folder.  Only a local master may run
    without the setting (tests): a temporary folder is registered then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-scratch-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps
    start from files, so a lost executor never replays the work before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; null counts as no text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def lanes_of(spark: SparkSession) -> int:
    """Lanes to spread a key over: the shuffle partitions, as a power of two."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(3, (n - 1).bit_length())


def lane(lanes: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(lanes)).cast("int")


def lane_lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Left join of ``rows`` to ``table`` (one row per key), safe for hot keys.

    The distinct (key, lane) pairs meet the table first, at most one row per
    lane and key; rows then meet their own (key, lane) answer.  A key that
    holds a third of all rows is thus spread over every lane.  ``rows`` is
    read twice, so pass a written table.  Keys must not be null.
    """
    keys = list(keys)
    tagged = rows.withColumn("__lane", lane(lanes_of(rows.sparkSession), *spread_by))
    answers = tagged.select(*keys, "__lane").distinct().join(table, keys, "left")
    return tagged.join(answers, [*keys, "__lane"], "left").drop("__lane")
