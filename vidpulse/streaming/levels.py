"""Serving table whose read cost does not grow with the number of batches.

A micro-batch becomes a small parquet run of its own, so a write touches
nothing that exists.  ``merge`` folds the runs of finished batches with the
lower levels into one sorted run: level ``k`` holds at most
``level_rows * fanout ** k`` rows in one run, hence a table of N rows has about
log(N) runs, and a row is rewritten about ``fanout`` times a level.  Runs are
range-partitioned and sorted by key, so a look-up by key skips files and row
groups by their statistics.

The manifest names the merged runs and the last batch id they hold.  It is a
new file per merge, renamed into place: a reader takes the newest manifest and
adds the runs of later batches, so it sees every batch exactly once before,
during and after a merge.  The stream is the only writer of batch runs and
never reads the manifest to write; merges are the only writers of manifests,
and of two merges at a time one wins and the other leaves nothing visible.

A batch counts once its run is complete.  A repeated batch id gets a run of its
own, of which readers take one; repeats of merged batches are left out.
``vacuum`` removes runs that only older manifests need.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.sources import folders
from vidpulse.streaming.sinks import BATCH_COL, UpsertTable

_BATCH_RUN = re.compile(r"batch=(-?\d+)-([0-9a-f]+)$")
_MANIFEST = re.compile(r"(\d{12})\.json$")


@dataclass(frozen=True)
class Run:
    level: int
    name: str
    rows: int


@dataclass(frozen=True)
class Manifest:
    """State after a merge: ``upto``: the newest batch id that ``runs`` hold."""

    version: int = 0
    upto: int | None = None
    runs: tuple[Run, ...] = ()


class LevelledTable(UpsertTable):
    """Newest row per key (``sums=None``), or sums of the ``sums`` columns per
    key, over all batches written so far.

    ``merge_every``: merge within the stream after so many unmerged batches
    (None: another process calls ``merge``).  ``level_rows``: rows of level 0
    as a whole; ``file_rows``: rows of one file of a merged run.  A table
    belongs to one checkpoint: batch ids only grow, but for repeats of the
    last one; ``repeats="ignore"`` also takes older ids for repeats.
    """

    def __init__(self, path: str, keys: Sequence[str], date_col: str = "window_start", sums: Sequence[str] | None = None,
                 merge_every: int | None = 16, level_rows: int = 1_000_000, fanout: int = 8, file_rows: int = 4_000_000,
                 repeats: str = "raise"):
        super().__init__(path, keys, date_col)
        self.sums = None if sums is None else list(sums)
        self.value_cols = self.sums
        self.merge_every, self.level_rows, self.fanout, self.file_rows, self.repeats = merge_every, level_rows, fanout, file_rows, repeats

    # state ----------------------------------------------------------------
    def manifest(self, spark: SparkSession) -> Manifest:
        """The newest manifest."""
        found = [n for n in folders.names(spark, f"{self.path}/manifests") if _MANIFEST.match(n)]
        return self._load(spark, found[-1]) if found else Manifest()

    def _load(self, spark: SparkSession, name: str) -> Manifest:
        state = json.loads(folders.read_text(spark, f"{self.path}/manifests/{name}"))
        return Manifest(state["version"], state["upto"], tuple(Run(**r) for r in state["runs"]))

    def _batches(self, spark: SparkSession, after: int | None) -> dict[int, str]:
        """Run of each finished batch beyond ``after``; of repeats the last by name."""
        out = {}
        for name in folders.names(spark, f"{self.path}/batches"):
            at = _BATCH_RUN.match(name)
            if at and (after is None or int(at[1]) > after) and folders.exists(spark, f"{self.path}/batches/{name}/_SUCCESS"):
                out[int(at[1])] = name
        return out

    def runs(self, spark: SparkSession) -> list[str]:
        """Folders that a read of this moment scans."""
        state = self.manifest(spark)
        merged = [f"{self.path}/runs/{r.name}" for r in state.runs]
        return merged + [f"{self.path}/batches/{n}" for n in self._batches(spark, state.upto).values()]

    # writing --------------------------------------------------------------
    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark, batch_id = batch.sparkSession, int(batch_id)
        upto = self.manifest(spark).upto
        if batch_id < 0 and (upto is not None or batch_id in self._batches(spark, None)):
            return  # an initial state is written once
        if upto is not None and batch_id <= upto:
            if batch_id < upto and self.repeats == "raise":
                raise ValueError(f"batch {batch_id} comes after batch {upto}: {self.path} belongs to another checkpoint")
            return  # a repeat of a batch that is merged already
        run = f"{self.path}/batches/batch={batch_id}-{uuid.uuid4().hex}"
        batch.withColumn(BATCH_COL, F.lit(batch_id).cast("bigint")).write.parquet(run)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:  # foreachBatch hook
        self.write_batch(batch, batch_id)
        if self.merge_every and len(self._batches(batch.sparkSession, self.manifest(batch.sparkSession).upto)) >= self.merge_every:
            self.merge(batch.sparkSession)
            self.vacuum(batch.sparkSession)

    # reading --------------------------------------------------------------
    def _scan(self, spark: SparkSession, paths: Sequence[str]) -> DataFrame:
        if not paths:
            raise ValueError(f"nothing has been written to {self.path}")
        return spark.read.parquet(*paths)

    def _raw(self, spark: SparkSession, since: str | None, only: DataFrame | None) -> DataFrame:
        return self._narrowed(self._scan(spark, self.runs(spark)), since, only)

    def _folded(self, raw: DataFrame) -> DataFrame:
        """One row per key, with the batch that it is from."""
        if self.sums is not None:
            sums = [F.sum(c).cast("bigint").alias(c) for c in self.sums]
            return raw.groupBy(*self.keys).agg(*sums, F.max(BATCH_COL).alias(BATCH_COL))
        values = [c for c in raw.columns if c not in self.keys]
        newest = raw.groupBy(*self.keys).agg(F.max_by(F.struct(*values), BATCH_COL).alias("_v"))
        return newest.select(*self.keys, *[F.col(f"_v.{c}").alias(c) for c in values])

    def _fold(self, raw: DataFrame) -> DataFrame:
        return self._folded(raw).drop(BATCH_COL)

    def compact(self, spark: SparkSession, path: str | None = None) -> UpsertTable:
        """Merge everything into one run; with ``path`` as a new table."""
        if path is not None:
            return super().compact(spark, path)
        self.merge(spark, all_levels=True)
        return self

    # merging --------------------------------------------------------------
    def level_limit(self, level: int) -> int:
        return self.level_rows * self.fanout**level

    def merge(self, spark: SparkSession, all_levels: bool = False) -> bool:
        """Fold the finished batches, and the levels that would grow beyond
        their size, into one run.  True if this call published a manifest."""
        state = self.manifest(spark)
        batches = self._batches(spark, state.upto)
        if not batches and not (all_levels and len(state.runs) > 1):
            return False
        inputs = [f"{self.path}/batches/{n}" for n in batches.values()]
        rows = self._scan(spark, inputs).count() if inputs else 0
        by_level = {r.level: r for r in state.runs}
        level, taken = 0, []
        while True:  # the lowest level that holds the new rows and all levels up to it
            if level in by_level:
                taken.append(by_level[level])
            held = rows + sum(r.rows for r in taken)
            if held <= self.level_limit(level) and not (all_levels and len(taken) < len(by_level)):
                break
            level += 1
        inputs += [f"{self.path}/runs/{r.name}" for r in taken]
        name = f"run-{uuid.uuid4().hex}"
        files = max(1, math.ceil(held / self.file_rows))
        merged = self._folded(self._scan(spark, inputs)).repartitionByRange(files, *self.keys).sortWithinPartitions(*self.keys)
        merged.write.parquet(f"{self.path}/runs/{name}")
        kept = spark.read.parquet(f"{self.path}/runs/{name}").count()  # read from the file footers
        runs = [r for r in state.runs if r not in taken] + [Run(level, name, kept)]
        upto = max([*batches, *([] if state.upto is None else [state.upto])])
        text = json.dumps({"version": state.version + 1, "upto": upto, "runs": [vars(r) for r in runs]})
        done = folders.create_text(spark, f"{self.path}/manifests/{state.version + 1:012d}.json", text)
        if not done:  # another merge was first
            folders.remove(spark, f"{self.path}/runs/{name}")
        return done

    def vacuum(self, spark: SparkSession, keep: int = 3) -> int:
        """Remove what the newest ``keep`` manifests do not need; a read that
        began under one of them stays whole.  Returns the folders removed."""
        found = [n for n in folders.names(spark, f"{self.path}/manifests") if _MANIFEST.match(n)]
        kept = [self._load(spark, n) for n in found[-keep:]]
        if len(found) <= keep:
            return 0
        needed = {r.name for m in kept for r in m.runs}
        gone = [f"{self.path}/batches/{n}" for n in folders.names(spark, f"{self.path}/batches")
                if (at := _BATCH_RUN.match(n)) and int(at[1]) <= min(m.upto for m in kept)]
        old = [self._load(spark, n) for n in found[:-keep]]
        gone += [f"{self.path}/runs/{r}" for r in sorted({r.name for m in old for r in m.runs} - needed)]
        for path in gone:
            folders.remove(spark, path)
        for name in found[:-keep]:
            folders.remove(spark, f"{self.path}/manifests/{name}")
        return len(gone)
