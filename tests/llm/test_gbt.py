"""Quality classifier: held-out accuracy, trees against a row-by-row walk."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidpulse.llm import quality_gbt as G

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.id: r for r in G.score(docs, G.train_on(docs, labels)).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    rows = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([y == p for y, p in rows]) > 0.95
    assert np.mean([p for y, p in rows if y == 1]) > 0.95


def test_held_out_labels_do_not_train(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(G.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = G.train_on(docs, labels), G.train_on(docs, turned)
    assert (a.value == b.value).all() and (a.feature == b.feature).all()


def test_bound_of_training_rows(spark, monkeypatch):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    seen = []
    monkeypatch.setattr(G, "train", lambda x, y: seen.append(len(x)))
    G.train_on(docs.union(docs), labels, most=50)
    assert seen == [50]


def walk(trees, x):
    total = trees.start
    inner = trees.feature.shape[1]
    for t in range(len(trees.feature)):
        node = 0
        while node < inner:
            node = 2 * node + 1 + int(x[trees.feature[t, node]] > trees.threshold[t, node])
        total += trees.value[t, node - inner]
    return 1 / (1 + np.exp(-total))


def test_flat_arrays_match_a_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    trees = G.train(x, y, trees=20)
    assert np.allclose(trees.score(x), [walk(trees, r) for r in x])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.97


def test_training_without_two_labels():
    assert G.train(np.zeros((0, 1)), np.zeros(0)).score(np.zeros((3, 4))).tolist() == [0.5] * 3
    assert (G.train(np.ones((9, 2)), np.ones(9)).score(np.ones((2, 2))) > 0.9).all()
    constant = G.train(np.ones((40, 2)), np.arange(40) % 2.0)
    assert np.allclose(constant.score(np.ones((2, 2))), 0.5)


def test_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 0, "x"), (None, 1, 0, "x"), (5, None, 0, "x"), (7, 1, 0, "x"), (12, 0, 0, "x")], "doc_id long, quality int, toxic int, text string")
    trees = G.train_on(edge_docs, labels)
    got = G.score(edge_docs, trees).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert G.score(no_docs, trees).count() == 0
    assert G.train_on(no_docs, labels.limit(0)).score(np.zeros((1, 1))).tolist() == [0.5]


def test_same_text_same_score(edge_docs):
    from collections import defaultdict

    trees = G.Trees(np.zeros((0, 1), dtype=np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 0.0)
    by = defaultdict(set)
    for r in G.score(edge_docs, trees).collect():
        by[r.id].add(r.score)
    assert all(len(s) == 1 for s in by.values())


def brute_features(text):
    """The statistics in plain Python."""
    text = text or ""
    share = lambda a, b: a / b if b > 0 else 0.0
    sets = ["#*$%&|<>@^~={}[]_\\/+", "!?", ".,;:", "\"'()-", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "aeiouAEIOU", "\n", " \t\x0b\x0c\r"]
    out = [share(sum(c in s for c in text), len(text)) for s in sets]
    out.append(share(len(text.encode()) - len(text), len(text)))
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, sizes = len(w), [len(x) for x in w]
    out += [math.log1p(n), share(sum(sizes), n), share(sum(x * x for x in sizes), n), share(sum(x <= 3 for x in sizes), n),
            share(len(set(w)), n**0.5), share(len(set(w)), n), share(len(set(zip(w, w[1:]))), n), share(sum(a == b for a, b in zip(w, w[1:])), n)]
    lines = [x for x in text.split("\n") if x]
    return out + [share(len(set(lines)), len(lines)), share(len(text), len(lines))]


def test_statistics_equal_plain_python(spark, documents, edge_docs):
    rng = random.Random(7)
    odd = ["".join(rng.choice("smtqdCVvnwbxAEIOUaeiouBCD 01\n\t!?.,;:#*$%&|<>@^~={}[]_\\/+\"'()-éß漢\U0001f600") for _ in range(rng.randrange(80))) for _ in range(400)]
    extra = spark.createDataFrame([(k, t) for k, t in enumerate(odd)], "doc_id long, text string")
    for df in (documents, edge_docs, extra):
        for r in df.select("text", G.features(F.col("text")).alias("x")).collect():
            assert r.x == pytest.approx(brute_features(r.text))


def test_best_splits_equal_trying_every_one():
    rng = np.random.default_rng(3)
    codes, node, g, h = rng.integers(0, 6, (300, 4)), rng.integers(0, 3, 300), rng.normal(size=300), rng.random(300) + 0.1
    gain, feature, cut = G._best_splits(codes, node, 3, g, h, 6)
    L2, least = G.L2, G.LEAST_LEAF
    for k in range(3):
        own, best = node == k, (0.0, None)
        whole = g[own].sum() ** 2 / (h[own].sum() + L2)
        for f in range(4):
            for b in range(6):
                left, right = own & (codes[:, f] <= b), own & (codes[:, f] > b)
                if min(left.sum(), right.sum()) >= least:
                    value = g[left].sum() ** 2 / (h[left].sum() + L2) + g[right].sum() ** 2 / (h[right].sum() + L2) - whole
                    best = max(best, (value, (f, b)), key=lambda x: x[0])
        assert gain[k] == pytest.approx(best[0]) and (best[1] is None or (feature[k], cut[k]) == best[1])
