import hashlib
import math
import zlib
from string import ascii_lowercase, ascii_uppercase

import duckdb
import pytest
from pyspark.sql import functions as F

from vidpulse.llm import merkle_manifest as M
from vidpulse.llm import queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, at):
    """Root of the nodes and the runs (before, after) on the way from one."""
    way = []
    while len(nodes) > 1:
        first = at - at % 8
        way.append((nodes[first:at], nodes[at + 1 : first + 8]))
        nodes, at = [digest("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)], at // 8
    return nodes[0], way


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [sorted(groups[g], key=lambda x: x[:3]) for g in names]
    subroots = [climb([x[2] for x in tree], 0)[0] for tree in trees]
    out = []
    for k, tree in enumerate(trees):
        root, upper = climb(subroots, k)
        for at, (_, _, own, r) in enumerate(tree):
            way = climb([x[2] for x in tree], at)[1] + upper
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            folded = leaf((*r[:4], r[4].translate(LOWER))) if changed else own
            for before, after in way:
                folded = digest("".join((*before, folded, *after)))
            proof = digest("".join("".join((*b, *a)) for b, a in way))
            out.append((r[0], own, subroots[k], root, proof, folded, folded == root))
    return sorted(out, key=str)


def tampered():
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return {"text": F.when(hit, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))}


def proved(docs, local=M.LOCAL):
    out = M.prove(docs, FIELDS, presented=tampered(), local=local)
    return sorted(map(tuple, out.drop("grp").select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("local", [1, 2, 4])
def test_equals_brute_force_whatever_the_superblock(spark, local):
    sizes = {"a": 1, "b": 8, "é": 9, None: 64, "c": 65, "": 131, "zz": 520}
    rows = [(k, f"s{k % 3}", lang, k, f"Text {k} É") for lang, n in sizes.items() for k in range(n)]
    rows += [(None, None, "c", None, None), (None, None, "c", None, None), (7, "same id", "c", 1, "X"), (2**62 + 1, "", "c", 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    assert proved(docs, local) == brute(rows)


def test_one_language_holds_all_rows_over_several_superblocks(spark):
    n = M.RUN**M.LOCAL + 3
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).cast("long").alias("n_chars"), F.concat(F.lit("T"), "id").alias("text"))
    assert proved(docs) == brute([(k, "s", "en", 1, f"T{k}") for k in range(n)])
    report = M.manifest(docs, FIELDS).collect()
    assert len(report) == 1 and report[0]["n_leaves"] == n


def test_edge_documents(edge_docs, no_docs):
    rows = [tuple(r) for r in edge_docs.select(*FIELDS).collect()]
    assert proved(edge_docs) == brute(rows)
    assert proved(no_docs) == []


def test_untampered_rows_verify_and_changed_ones_do_not(spark, documents):
    out = M.prove(documents, FIELDS, presented=tampered()).collect()
    changed = {r["doc_id"] for r in documents.select("doc_id", "text").collect()
               if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"].translate(LOWER) != r["text"]}
    assert changed and {r["id"] for r in out if not r["verified"]} == changed
    assert len({r["root"] for r in out}) == 1


def test_sql_agrees(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.sql(queries.SQL["op11_merkle_manifest"])
    got = queries.op11_merkle_manifest(spark, sf)
    assert sorted(want.columns) == sorted(got.columns)
    names = sorted(want.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.select(*names).fetchall())


def test_levels_end_where_the_tree_ends():
    for n in range(1, 600):
        assert len(M._levels([str(k) for k in range(n)], 0, 4)) == 1 + (math.ceil(math.log(n, 8) - 1e-9) if n > 1 else 0)
    assert len(M._levels(["x"], 3, 4)) == 5
