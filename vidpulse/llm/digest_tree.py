"""Exact dedup: tree-merge of sorted digest runs, DataFrame functions only.

Rows are dealt to lanes by row number, so neither copies of one row nor null
ids meet in a lane.  A lane is a partition that holds a sorted run of (digest,
smallest id, count).  In every binomial round the lanes whose numbers differ in
the same few bits exchange their runs: a digest moves to the lane that carries
its own bits there, the rows of a lane are shuffled to one partition and sorted
(external, spilling), and up to ``2**BITS`` runs merge into one by a sorted
aggregation that needs no further shuffle.  After the last round each digest
sits in one lane, merged from at most ``2**BITS`` rows per round, however many
copies there are.

A merge never trusts the digest alone: byte length and an independent 64-bit
hash of the normalised text are part of the key at every level.

Defined results: null text counts as empty; a null id never stays while a
row with an id has the same text (a group of null ids has keep_id null);
among fully equal (id, text) rows one stays; no rows give no rows; further
columns are ignored, or passed through by ``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.llm.common import SPACE, lane, lanes_of, written

#: Bits of the lane number settled in a round; 2**BITS runs merge at once.
BITS = 3
KEY = ["digest", "n_bytes", "check"]


def _digests(docs: DataFrame, text: str) -> list:
    normal = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+", " ")
    return [F.unhex(F.sha2(normal, 256)).alias("digest"), F.octet_length(normal).cast("long").alias("n_bytes"),
            F.xxhash64(normal).alias("check")]


def _merge(runs: DataFrame, lanes: int) -> DataFrame:
    """Each lane's rows to its partition, in order, and equal keys to one row."""
    own = runs.repartition(lanes, "lane").sortWithinPartitions("lane", *KEY)
    return own.groupBy("lane", *KEY).agg(F.min("head").alias("head"), F.sum("n").alias("n"))


def merge_tree(rows: DataFrame, lanes: int) -> DataFrame:
    """One row per digest: KEY, ``head`` (null flag, smallest id, its first
    row) and ``n``, from ``rows`` with lane, row, id and KEY."""
    runs = rows.select("lane", *KEY, F.struct(F.col("id").isNull().alias("none"), "id", "row").alias("head"), F.lit(1).alias("n"))
    runs = _merge(runs, lanes)
    home = F.pmod(F.xxhash64("digest"), F.lit(lanes)).cast("int")
    for shift in range(0, lanes.bit_length() - 1, BITS):
        mask = ((1 << BITS) - 1) << shift & lanes - 1
        moved = F.col("lane").bitwiseAND(~mask & lanes - 1).bitwiseOR(home.bitwiseAND(mask))
        runs = _merge(runs.withColumn("lane", moved), lanes)
    return runs.drop("lane")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, digest, n_bytes, check, keep_id, group_size, kept."""
    lanes = lanes_of(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), *_digests(docs, text), F.monotonically_increasing_id().alias("row"))
    rows = written(rows.withColumn("lane", lane(lanes, "row")), "digest-rows")
    merged = merge_tree(rows, lanes)
    # back down: a lane asks once per digest, its rows then read the lane's answer
    answers = rows.select("lane", *KEY).distinct().join(merged, KEY)
    out = rows.join(answers, ["lane", *KEY])
    return out.select(
        "id", *KEY, F.col("head.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("head.row")).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row left of each group of equal texts, all columns."""
    kept = exact_groups(docs, id_col, text).where("kept").select(F.col("id").alias("k_id"), *[F.col(c).alias(f"k_{c}") for c in KEY])
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), *_digests(docs, text))
    once = rows.withColumn("nth", F.row_number().over(Window.partitionBy("id", *KEY).orderBy("id"))).where("nth = 1")
    match = F.col("id").eqNullSafe(F.col("k_id"))
    for c in KEY:
        match = match & (F.col(c) == F.col(f"k_{c}"))
    return once.join(kept, match, "left_semi").select("row.*")
