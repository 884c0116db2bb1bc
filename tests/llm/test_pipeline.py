"""The whole pipeline against a brute-force version, and the registry."""

import re
from collections import defaultdict

import public_tokenizers
import pytest
from vidpulse.llm import byte_bpe, mix_budget, queries
from test_dedup import brute_components, brute_fingerprint
from test_rules_mix import brute_targets

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_dedup", "mix_sources", "byte_bpe"]


def test_whole_run(spark, documents):
    from vidpulse.llm import quality_rules

    rules = {r["row"]["doc_id"]: r.kept for r in quality_rules.assess(documents).collect()}
    docs = sorted((r.doc_id, r.text or "", r.source) for r in documents.collect() if rules[r.doc_id])
    first = {}
    for d in docs:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", d[1]), d)
    docs = sorted(first.values())
    roots = brute_components([brute_fingerprint(t) for _, t, _ in docs])
    docs = [d for k, d in enumerate(docs) if roots[k] == k]
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t))
    targets = brute_targets(sizes)

    out = corpus_pipeline.run(spark, SMALL).collect()
    text = {i: (t, s) for i, t, s in docs}
    copies = defaultdict(int)
    for r in out:
        copies[r.doc_id] += 1
    assert set(copies) <= set(text) and max(copies.values()) <= 2 and all(r.round_trip for r in out)
    taken = defaultdict(int)
    for i, n in copies.items():
        taken[text[i][1]] += n * len(re.findall(r"[^\x20\x09-\x0D]+", text[i][0]))
    for s, t in targets.items():
        longest = max(len(x.split()) for x, own in text.values() if own == s)
        assert abs(taken[s] - t) <= max(1, longest)
    bpe = byte_bpe.load(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    assert all(bytes(r.ids) == bpe.encode(text[r.doc_id][0]) and r.n_tokens == len(r.ids) // 4 for r in out)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, edge_docs, no_docs, name, stage):
    assert stage(spark, edge_docs, SMALL).columns == edge_docs.columns
    assert stage(spark, no_docs, SMALL).count() == 0


def test_registry():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {re.match(r"op\d+_", q)[0] for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert mix_budget.BUDGET_RATIO == 1.5


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    rel = con.execute(queries.SQL[name])
    names = [c[0] for c in rel.description]
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(df.columns) == sorted(names)
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == sorted(str(r) for r in rel.fetchall())
