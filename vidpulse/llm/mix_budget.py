"""Mixing sources to target weights by subset-sum budget fitting.

1. Sizes (words) are counted once per document; a histogram (source, size)
   holds the number of documents of each exact length.
2. Targets: sources in code-point order weigh 5, 2, 1, repeating, and share
   ``budget_ratio`` of all words; a target stops at ``max_copies`` times its
   source, the excess goes to the others by weight (water level).
3. Per source: whole copies of everything first; for the rest the same share
   of every length, then a bounded-knapsack dynamic programme over the
   histogram fills what rounding left.  It sees counts, never documents.
4. Documents of a length are taken in the order of a seeded hash.  Buckets
   (the hash's first bits, the more the more rows there are) with their counts
   place the cut.  Buckets before it are taken, those after it are not; only
   the rows of the one bucket that the cut falls into are ranked: a length may
   hold a third of all rows.  Rows that are equal in all that tells rows apart
   are ranked as one with their number, so copies of one row are no hot bucket.

Defined results: null or blank text has size 0 and takes 0 words (it gets
the whole copies of its source); a null source comes last; repeated rows
count each; ties in the hash go by id; no rows give no rows; further columns
are ignored, or passed through by ``mixed``.  Reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.llm.common import words, written
from vidpulse.operators.prefix import running_sum

WEIGHTS = (5, 2, 1)
BUDGET_RATIO, MAX_COPIES, SEED = 1.5, 2, 20
#: Budget that the dynamic programme fills exactly; larger rests shrink first.
EXACT = 32_768
#: Rows that a hash bucket should hold at most, were all of one source and
#: size; there are at least 2 ** LEAST_BITS buckets.
BUCKET_ROWS, LEAST_BITS = 65_536, 8


def bounded_knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size to take so that their sum comes closest to
    ``budget`` from below; O(budget) memory."""
    take = np.zeros(len(sizes), dtype=np.int64)
    came_by = np.full(budget + 1, -1, dtype=np.int64)  # first chunk that reached the sum
    came_by[0] = -2
    chunks: list[tuple[int, int]] = []
    for k, (size, count) in enumerate(zip(sizes.tolist(), counts.tolist())):
        left, many = min(count, budget // size) if size else 0, 1
        while left and came_by[budget] == -1:
            many = min(many, left)
            step = size * many
            new = np.flatnonzero((came_by[:-step or None] != -1) & (came_by[step:] == -1)) + step if step <= budget else []
            came_by[new] = len(chunks)
            chunks.append((k, many))
            left -= many
            many *= 2
    at = int(np.flatnonzero(came_by != -1)[-1])
    while at:
        k, many = chunks[came_by[at]]
        take[k] += many
        at -= int(sizes[k]) * many
    return take


def fit_source(sizes: np.ndarray, counts: np.ndarray, budget: int) -> tuple[int, np.ndarray]:
    """Whole copies of everything, and extra documents per size."""
    total, extra = int((sizes * counts).sum()), np.zeros(len(sizes), dtype=np.int64)
    if not total:
        return 1, extra
    base, rest = divmod(max(0, budget), total)
    share = rest / total
    extra = np.minimum(np.floor(counts * share).astype(np.int64), counts)
    rest -= int((extra * sizes).sum())
    by_fraction = np.argsort(-(counts * share - extra), kind="stable")
    for most in (1, None):  # one more of each length first, then as many as fit
        for k in by_fraction.tolist():
            size = int(sizes[k])
            if size and rest > EXACT:
                more = min(int(counts[k] - extra[k]), max(0, rest - EXACT // 2) // size, most or rest)
                extra[k] += more
                rest -= more * size
    for k in np.argsort(-sizes, kind="stable").tolist():  # long documents may still fit whole
        size = int(sizes[k])
        if EXACT < rest >= size > 0:
            more = min(int(counts[k] - extra[k]), rest // size)
            extra[k] += more
            rest -= more * size
    extra += bounded_knapsack(sizes, counts - extra, min(rest, 2 * EXACT))
    return base, extra


def _targets(hist: DataFrame, ratio: float, copies: int) -> DataFrame:
    """(skey, source_size, target): one row per source.  Sources may be many
    (host names), so their order comes from range-partitioned running sums."""
    sizes = hist.groupBy("skey").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    s = running_sum(sizes, ["skey"], out="place")
    weight: Column = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("place") - 1) % len(WEIGHTS) + 1).cast("int"))
    s = s.withColumn("weight", weight.cast("long")).withColumn("most", F.lit(float(copies)) * F.col("source_size"))
    # sources fill up in the order of most / weight; the level is set by the first that doesn't
    s = s.withColumn("fills", F.col("most") / F.col("weight"))
    s = running_sum(s, ["fills", "skey"], weight=F.col("source_size"), out="size_upto")
    s = running_sum(s, ["fills", "skey"], weight=F.col("weight"), out="weight_upto")
    s = written(s, "mix-sources")
    every = s.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    full_before = F.lit(float(copies)) * (F.col("size_upto") - F.col("source_size"))
    weight_left = F.col("all_weight") - F.col("weight_upto") + F.col("weight")
    level = (F.lit(ratio) * F.col("all_size") - full_before) / weight_left
    s = s.crossJoin(F.broadcast(every)).withColumn("level", F.when(level * F.col("weight") <= F.col("most"), level)).drop("all_size", "all_weight")
    s = s.crossJoin(F.broadcast(s.agg(F.max("level").alias("top"))))
    capped = F.col("most") <= F.coalesce(F.col("top") * F.col("weight"), F.col("most"))
    return s.select("skey", "source_size", F.when(capped, F.col("most")).otherwise(F.col("top") * F.col("weight")).alias("target"))


#: What tells rows apart: id, hash and size of the text, source.
TAG = ["id", "hash", "n_bytes", "skey"]


def _tags(id_col: str, text: str, source: str) -> list:
    whole = F.coalesce(F.col(text), F.lit(""))
    skey = F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))
    return [F.col(id_col).alias("id"), F.xxhash64(whole).alias("hash"), F.octet_length(whole).cast("long").alias("n_bytes"), skey.alias("skey")]


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
             ratio: float = BUDGET_RATIO, copies: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """Per row: TAG, size, source_size, target, copies, taken."""
    rows = docs.select(*_tags(id_col, text, source), F.size(words(F.col(text))).cast("long").alias("size"))
    rows = written(rows.withColumn("draw", F.xxhash64(F.lit(seed).cast("long"), "id", "hash")), "mix-rows")
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, rows.count()) / BUCKET_ROWS)))
    rows = rows.withColumn("bucket", F.shiftright("draw", 64 - bits).cast("int"))
    counted = written(rows.groupBy("skey", "size", "bucket").agg(F.count("*").alias("n")), "mix-counts")
    hist = counted.groupBy("skey", "size").agg(F.sum("n").alias("n"))
    lengths = hist.join(_targets(hist, ratio, copies), "skey")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size", ascending=False, ignore_index=True)
        base, extra = fit_source(part["size"].to_numpy(), part["n"].to_numpy(), round(part["target"][0]))
        return part[["skey", "size", "source_size", "target"]].assign(base=base, extra=extra)

    fitted = written(lengths.groupBy("skey").applyInPandas(fit, "skey string, size long, source_size long, target double, base long, extra long"), "mix-fit")
    earlier = Window.partitionBy("skey", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = counted.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(fitted, ["skey", "size"])
    quota = quota.withColumn("need", F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.col("before"))))
    quota = written(quota.withColumn("cut", (F.col("need") > 0) & (F.col("need") < F.col("n"))), "mix-quota")
    met = rows.join(quota, ["skey", "size", "bucket"])
    whole = met.where(~F.col("cut")).withColumn("got", F.when(F.col("need") > 0, 1).otherwise(0))
    at_cut = met.where("cut").drop("bucket", "n", "before", "extra", "cut")
    out = whole.select(*TAG, "size", "source_size", "target", (F.col("base") + F.col("got")).cast("long").alias("copies"))
    out = out.unionByName(_ranked(at_cut).select(*out.columns))
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Rows of cut buckets with their copies.  Equal rows count as one with
    their number first (a bucket then holds about ``BUCKET_ROWS`` of them), are
    ranked by draw, and are dealt out again."""
    facts = ["base", "need", "source_size", "target"]
    same = rows.groupBy("skey", "size", "draw", "id", "hash", "n_bytes", *facts).agg(F.count("*").alias("n"))
    order = Window.partitionBy("skey", "size").orderBy("draw", "id", "hash", "n_bytes")  # one bucket of each has the cut
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    more = same.withColumn("more", F.greatest(F.lit(0), F.least(F.col("n"), F.col("need") - before)))
    # ``more`` of the equal rows get one copy more: the first ones of each block of a thousand
    blocks = more.withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1000))))
    each = blocks.withColumn("row", F.explode(F.sequence(F.col("block") * 1000, F.least(F.col("n"), F.col("block") * 1000 + 1000) - 1)))
    return each.withColumn("copies", (F.col("base") + F.when(F.col("row") < F.col("more"), 1).otherwise(0)).cast("long"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies."""
    plan = plan_mix(docs, id_col, text, source, **options)
    # rows that repeat a document have copies n or n + 1; any of them may get the more
    plan = plan.groupBy(*TAG).agg(F.min("copies").alias("least"), F.sum("copies").alias("all"), F.count("*").alias("n"))
    wide = docs.select(F.struct("*").alias("row"), *_tags(id_col, text, source))
    wide = wide.withColumn("nth", F.row_number().over(Window.partitionBy(*TAG).orderBy("hash")))
    match = F.lit(True)
    for c in TAG:
        match = match & F.col(f"w.{c}").eqNullSafe(F.col(f"p.{c}"))
    got = F.col("least") + F.when(F.col("nth") <= F.col("all") - F.col("least") * F.col("n"), 1).otherwise(0)
    taken = wide.alias("w").join(plan.alias("p"), match).select("row", got.cast("int").alias("copies"))
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
