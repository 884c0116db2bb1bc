"""Exact and SimHash dedup against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vidpulse.llm import digest_tree, simhash_trie

SPACES = re.compile(r"[\x20\x09-\x0D]+")


def expected_groups(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[SPACES.sub(" ", t or "")].append(i)
    return {t: (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def check_exact(df):
    pairs = [(r.doc_id, r.text) for r in df.collect()]
    want = expected_groups(pairs)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    got = digest_tree.exact_groups(df).collect()
    assert len(got) == len(pairs)
    assert sorted(str((r.id, bytes(r.digest).hex())) for r in got) == sorted(
        str((i, hashlib.sha256(SPACES.sub(" ", t or "").encode()).hexdigest())) for i, t in pairs)
    for r in got:
        assert (r.keep_id, r.group_size) == by_sha[bytes(r.digest).hex()]
    assert sum(r.kept for r in got) == len(want)
    kept = digest_tree.deduplicate(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert sorted(str((r.doc_id, SPACES.sub(" ", r.text or ""))) for r in rows) == sorted(str((v[0], t)) for t, v in want.items())


def test_exact_documents(documents):
    check_exact(documents)


def test_exact_edge_cases(edge_docs):
    check_exact(edge_docs)


def test_exact_nothing(no_docs):
    assert digest_tree.exact_groups(no_docs).count() == 0
    assert digest_tree.deduplicate(no_docs).count() == 0


@pytest.mark.parametrize("lanes", [8, 16, 64])
def test_tree_meets_every_digest_once(spark, lanes):
    from pyspark.sql import functions as F

    rows = spark.range(5000).select(
        F.col("id"), F.unhex(F.sha2((F.col("id") % 700).cast("string"), 256)).alias("digest"), F.lit(1).cast("long").alias("n_bytes"),
        F.lit(2).cast("long").alias("check"), (F.col("id") * 7 % lanes).cast("int").alias("lane"))
    got = digest_tree.merge_tree(rows.withColumn("row", F.col("id")), lanes).collect()
    assert len(got) == 700 and sum(r.n for r in got) == 5000
    assert sorted(r["head"].id for r in got) == list(range(700))


def test_equal_digests_of_other_texts_stay_apart(spark):
    from pyspark.sql import functions as F

    rows = spark.range(10).select("id", F.lit(b"same").alias("digest"), F.lit(1).cast("long").alias("n_bytes"),
                                  (F.col("id") % 2).alias("check"), F.lit(0).alias("lane"))
    assert digest_tree.merge_tree(rows.withColumn("row", F.col("id")), 8).count() == 2


def brute_fingerprint(text, k=3):
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=3):
    a, label = np.array(fps, dtype=np.uint64), list(range(len(fps)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= bits) + i + 1:
            p, q = find(i), find(int(j))
            label[max(p, q)] = min(p, q)
    return [find(i) for i in range(len(a))]


def check_near(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    got = simhash_trie.near_groups(df).collect()
    assert sorted(str((r.id, r.fp & (1 << 64) - 1, r.component_id)) for r in got) == sorted(
        str((i, f, least.get(r))) for (i, _), f, r in zip(rows, fps, roots))
    kept = simhash_trie.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(least.get(r)) for r in set(roots))


def test_near_documents(documents):
    check_near(documents)


def test_near_edge_cases(edge_docs):
    check_near(edge_docs)


def test_near_nothing(no_docs):
    assert simhash_trie.near_groups(no_docs).count() == 0
    assert simhash_trie.deduplicate(no_docs).count() == 0


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centers = rng.integers(0, 1 << 63, size=max(1, n // 40), dtype=np.uint64)
    fps = centers[rng.integers(0, len(centers), n)]
    for _ in range(4):
        fps ^= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    return np.unique(fps)


@pytest.mark.parametrize("width,seed", [(48, 1), (48, 2), (12, 3)])
def test_trie_links_match_all_pairs(width, seed, monkeypatch):
    monkeypatch.setattr(simhash_trie, "FRONTIER", 500)  # many slices of the frontier
    rng = np.random.default_rng(seed)
    rest = clustered(1500, seed) & np.uint64((1 << width) - 1)
    node = rng.integers(0, 3, len(rest))
    order = np.lexsort((rest, node))
    node, rest = node[order], rest[order]
    got = simhash_trie.trie_links(node, rest, width, 3)
    for k in range(3):
        own = np.flatnonzero(node == k)
        assert (np.array(brute_components(rest[own])) + own[0] == got[own]).all()


def test_large_nodes_are_split_exactly(spark, monkeypatch):
    from pyspark.sql import functions as F

    fps = clustered(1200, 5) | np.uint64(0xFFFF << 48)  # one shared block
    monkeypatch.setattr(simhash_trie, "MAX_NODE", 64)
    prints = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    roots = {r.fp: r.root for r in simhash_trie.components(simhash_trie.links(prints)).collect()}
    label = brute_components(fps)
    groups = defaultdict(set)
    for f, r in zip(fps.view(np.int64).tolist(), label):
        groups[r].add(f)
    for members in groups.values():
        assert len({roots.get(f, f) for f in members}) == 1
    assert len({roots.get(f, f) for f in fps.view(np.int64).tolist()}) == len(groups)
    assert prints.select(F.count("*")).first()[0] == len(fps)


def test_chain_of_links_is_one_component(spark):
    fps = [(1 << k) - 1 for k in range(0, 61, 3)]  # neighbours differ by 3 bits, ends by 60
    prints = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = simhash_trie.components(simhash_trie.links(prints)).collect()
    assert len(roots) == len(fps) - 1 and {r.root for r in roots} == {0}


def test_a_row_repeated_for_a_third_of_the_table(spark):
    """Copies of one row, and null ids with one text, are spread over the lanes; one of them stays."""
    same = spark.range(1500).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same text").alias("text"))
    none = spark.range(1500).select(F.lit(None).cast("long").alias("doc_id"), F.lit("no id").alias("text"))
    rest = spark.range(1500).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("t "), F.col("id") % 700).alias("text"))
    docs = same.union(none).union(rest).repartition(5)
    out = digest_tree.exact_groups(docs)
    assert out.count() == 4500 and out.where("kept").count() == 702
    for row_id, keep in ((7, 7), (None, None)):
        own = out.where(F.col("id").eqNullSafe(F.lit(row_id).cast("long"))).groupBy("keep_id", "group_size").agg(F.sum(F.col("kept").cast("int")).alias("kept")).collect()
        assert [tuple(r) for r in own] == [(keep, 1500, 1)]
    assert digest_tree.deduplicate(docs).count() == 702


def test_a_lane_is_a_partition(spark):
    rows = spark.range(1000).select(F.col("id"), F.col("id").alias("row"), F.unhex(F.sha2((F.col("id") % 300).cast("string"), 256)).alias("digest"),
                                    F.lit(1).cast("long").alias("n_bytes"), F.lit(1).cast("long").alias("check"), (F.col("id") % 16).cast("int").alias("lane"))
    tree = digest_tree.merge_tree(rows, 16)
    assert tree.count() == 300
    plan = tree._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(lane") == 3  # one exchange of runs a round, none for the aggregation
    assert "SortAggregate" in plan and "HashAggregate" not in plan
