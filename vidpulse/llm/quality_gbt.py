"""Quality classifier: histogram gradient-boosted trees over text statistics.

Statistics of whole texts are Spark expressions; only their numbers reach
Python.  Training takes at most ``TRAIN_ROWS`` labelled rows (the bound is a
parameter; a hash of the id picks them), bins each statistic by quantiles
and grows trees from gradient histograms.  The trees are flattened into
arrays (feature, threshold, leaf value), so scoring a batch walks all rows
through all trees level by level in numpy.

Defined results: null and empty texts have all-zero statistics and get a
score like any other; ids that carry both labels, or null ones, do not train;
with labels of one kind or none the score is their share (0.5); repeated rows
score alike; no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.llm.common import let, words

TRAIN_ROWS, TREES, DEPTH, BINS, RATE, L2, LEAST_LEAF = 20_000, 80, 4, 64, 0.15, 1.0, 10
CUT = 0.7
#: Sets of characters without a common member; each is one mark of the text's
#: outline, so that one pass over the text serves all of them.
SETS = {
    "s": "#*$%&|<>@^~={}[]_\\/+", "m": "!?", "t": ".,;:", "q": "\"'()-", "d": "0123456789",
    "C": "BCDFGHJKLMNPQRSTVWXYZ", "V": "AEIOU", "v": "aeiou", "n": "\n", "w": " \t\x0b\x0c\r"}
#: Statistics per character of text, as marks that are added up: symbols, marks,
#: stops, quotes, digits, upper case, vowels, line feeds, white space.
COUNTED = ["s", "m", "t", "q", "d", "CV", "Vv", "n", "w"]


def _outline(text: Column) -> Column:
    """The text's marks: every character of a set as its mark, others gone
    with the letters that are marks themselves."""
    listed = "".join(SETS.values())
    marks = "".join(mark * len(chars) for mark, chars in SETS.items())
    return F.translate(text, listed + "".join(c for c in SETS if c not in listed), marks)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def features(text: Column) -> Column:
    """array<double> of statistics of one text."""
    text = F.coalesce(text, F.lit(""))
    n_chars = F.length(text)

    def of_outline(o: Column) -> Column:
        bytes_of = {mark: F.octet_length(o) - F.octet_length(F.replace(o, F.lit(mark), F.lit(""))) for mark in SETS}
        return let(F.array(*bytes_of.values()), lambda n: F.array(*[
            _share(functools.reduce(lambda x, y: x + y, [n[list(SETS).index(mark)] for mark in marks]), n_chars) for marks in COUNTED]))

    of_chars = F.concat(let(_outline(text), of_outline), F.array(_share(F.octet_length(text) - n_chars, n_chars)))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        pairs = F.zip_with(F.slice(w, 1, F.greatest(n - 1, F.lit(0))), F.slice(w, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        echo = F.size(F.filter(F.zip_with(w, F.slice(w, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: a.eqNullSafe(b)), lambda x: x))
        sizes = F.transform(w, lambda x: F.length(x))
        squares = F.aggregate(sizes, F.lit(0).cast("long"), lambda acc, x: acc + x * x)
        chars = F.aggregate(sizes, F.lit(0).cast("long"), lambda acc, x: acc + x)
        return let(F.size(F.array_distinct(w)), lambda different: F.array(
            F.log1p(n.cast("double")), _share(chars, n), _share(squares, n), _share(F.size(F.filter(sizes, lambda x: x <= 3)), n),
            _share(different, F.sqrt(n.cast("double"))), _share(different, n), _share(F.size(F.array_distinct(pairs)), n), _share(echo, n)))

    lines = F.filter(F.split(text, "\n"), lambda x: F.length(x) > 0)
    of_lines = let(lines, lambda x: F.array(_share(F.size(F.array_distinct(x)), F.size(x)), _share(n_chars, F.size(x))))
    return F.concat(of_chars, let(words(text), of_words), of_lines)


@dataclass
class Trees:
    """Complete binary trees in arrays: (tree, node) features and thresholds
    of inner nodes, (tree, leaf) values."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        total = np.full(len(x), self.start)
        if len(self.feature):
            row, tree = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
            node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
            inner = self.feature.shape[1]
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
            total += self.value[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def _best_splits(codes: np.ndarray, node: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray, bins: int):
    """(gain, feature, bin) per node from the gradient histograms."""
    n, width = codes.shape
    at = ((node[:, None] * width + np.arange(width)) * bins + codes).ravel()
    shape = (nodes, width, bins)
    sums = [np.bincount(at, weights=np.repeat(v, width), minlength=nodes * width * bins).reshape(shape).cumsum(axis=2) for v in (g, h, np.ones(n))]
    (gl, hl, nl), (gt, ht, nt) = sums, [s[:, :, -1:] for s in sums]
    gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
    gain[(nl < LEAST_LEAF) | (nt - nl < LEAST_LEAF)] = 0
    flat = gain.reshape(nodes, -1)
    best = flat.argmax(axis=1)
    return flat[np.arange(nodes), best], best // bins, best % bins


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees on the logistic loss."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(y), start)
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)  # no split: all rows go left
    value = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h, node = p - y, p * (1 - p), np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            gain, f, b = _best_splits(codes, node, width, g, h, BINS)
            for k in np.flatnonzero(gain > 1e-6):
                if b[k] < len(edges[f[k]]):
                    feature[t, first + k], threshold[t, first + k] = f[k], edges[f[k]][b[k]]
            node = 2 * node + (x[np.arange(len(y)), feature[t, first + node]] > threshold[t, first + node])
        value[t] = -RATE * np.bincount(node, weights=g, minlength=leaves) / (np.bincount(node, weights=h, minlength=leaves) + L2)
        margin += value[t, node]
    return Trees(feature, threshold, value, start)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", most: int = TRAIN_ROWS) -> Trees:
    """Trees from at most ``most`` labelled rows that are not held out."""
    agreed = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(
        F.min(label).alias("y"), F.max(label).alias("other")).where("y = other")
    picked = agreed.select("id", "y").orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(picked), "id")
    found = rows.select("id", "y", features(F.col("text")).alias("x")).groupBy("id").agg(F.min(F.struct("y", "x")).alias("row")).orderBy("id").select("row.*").toPandas()
    x = np.array(found["x"].tolist(), dtype=float) if len(found) else np.zeros((0, 1))
    return train(x, found["y"].to_numpy(dtype=float))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2)
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 1))
            s = np.concatenate([trees.score(x[k : k + 2048]) for k in range(0, batch.num_rows, 2048)]) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= CUT).astype(np.int32))], names=["id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), features(F.col(text)).alias("x"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
