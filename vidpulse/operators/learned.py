"""Sentence classes learnt from labelled sentences.

A log-linear model over hashed words and word pairs: the weight of a bucket
for a class is the logarithm of how often sentences of that class have it
(naive Bayes with add-one smoothing).  One grouped count fits it, so training
reads the labelled rows once, however many there are; the model is
``CLASSES * BUCKETS`` numbers at most.  It is applied as a column expression,
through the ``scorer`` argument of the sentiment operators: no user function,
no join.  Weights are whole thousandths, so sums do not depend on their order.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.functions.text import word_array

#: Sentence classes 0 (very negative) to 4 (very positive).
CLASSES = 5
#: Hash buckets of words and word pairs: three hexadecimal digits.
BUCKETS = 16**3


@dataclass(frozen=True)
class Model:
    """Weights in thousandths: ``prior`` per class, ``weights`` per class and bucket."""

    prior: tuple[int, ...]
    weights: tuple[tuple[int, ...], ...]


def features(sentence: Column) -> Column:
    """Buckets of the words of a sentence and of its pairs of neighbours."""
    def grams(words: Column) -> Column:
        pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
        return F.concat(words, F.filter(pairs, lambda p: p.isNotNull()))

    words = word_array(F.coalesce(sentence, F.lit("")))
    both = F.transform(F.array(words), grams)[0]  # words once per row
    return F.transform(both, lambda g: F.conv(F.substring(F.md5(g), 1, 3), 16, 10).cast("int"))


def fit(labelled: DataFrame, sentence: str = "sentence", label: str = "label", n: str | None = None) -> Model:
    """Model of labelled sentences (``label`` 0 to 4, others and null are left
    out); ``n``: how often a row counts."""
    times = F.lit(1) if n is None else F.col(n)
    rows = labelled.where(F.col(label).between(0, CLASSES - 1)).select(F.col(label).cast("int").alias("label"), times.cast("bigint").alias("n"), F.col(sentence).alias("s"))
    buckets = rows.select("label", "n", F.explode(F.concat(F.array(F.lit(-1)), features(F.col("s")))).alias("bucket"))  # -1 counts the sentence
    counts = {(r["label"], r["bucket"]): r["n"] for r in buckets.groupBy("label", "bucket").agg(F.sum("n").alias("n")).collect()}  # CLASSES * (BUCKETS + 1) rows at most
    sentences = [counts.get((c, -1), 0) for c in range(CLASSES)]
    thousandths = lambda part, whole: round(1000 * math.log(part / whole))
    weights = []
    for c in range(CLASSES):
        own = [counts.get((c, b), 0) for b in range(BUCKETS)]
        weights.append(tuple(thousandths(x + 1, sum(own) + BUCKETS) for x in own))
    return Model(tuple(thousandths(s + 1, sum(sentences) + CLASSES) for s in sentences), tuple(weights))


def scorer(model: Model) -> Callable[[Column], Column]:
    """Sentence column -> class column; of classes with one score the lowest."""
    tables = [F.split(F.lit(",".join(map(str, own))), ",").cast("array<int>") for own in model.weights]

    def total(found: Column, prior: int, table: Column) -> Column:
        return F.aggregate(found, F.lit(prior).cast("bigint"), lambda acc, b: acc + F.element_at(table, b + 1))

    def best(found: Column) -> Column:
        scores = F.array(*[total(found, prior, table) for prior, table in zip(model.prior, tables)])
        return F.transform(F.array(scores), lambda s: F.array_position(s, F.array_max(s)) - 1)[0]

    return lambda sentence: F.transform(F.array(features(sentence)), best)[0].cast("bigint")
