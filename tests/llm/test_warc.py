"""WARC archives: round trip, revisits, chunks and running digests."""

import base64
import hashlib
import io
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vidpulse.llm import warc_chunks as W

HARD = [
    (1, "http://a/\r\nX: y", "<p>é\U0001f600</p>"), (2, None, None), (3, "u", ""), (4, "u", "same"), (5, "ü v", "same"), (5, "u", "same"), (6, "u", "\r\n\r\nWARC/1.1\r\n"),
    (None, "n", "same"), (None, None, "only without id"), (7, "u", "x" * 70), (8, "u", "x" * 64), (9, "u", "x" * 128 + "é"), (10, "u", "x" * 63 + "é" * 100),
]


def expected(pages):
    best = {}
    for i, h in pages:
        best.setdefault(h or "", None)
        if i is not None and (best[h or ""] is None or i > best[h or ""]):
            best[h or ""] = i
    out = []
    for i, h in pages:
        raw, keep = (h or "").encode(), best[h or ""]
        out.append(str((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == keep else "revisit", None if i == keep else keep)))
    return sorted(out)


def summary(df):
    from vidpulse.llm import queries  # the digest columns of the registered query

    stored = F.col("record_type") == "response"
    rows = df.where("last").select(
        W.page_of(F.col("record")).alias("page_id"), F.when(stored, F.col("bytes_so_far")).otherwise(F.col("stated_bytes")).alias("n"),
        F.when(stored, F.col("digest_so_far")).otherwise(F.col("stated_digest")).alias("d"), "record_type", W.page_of(F.col("refers_to")).alias("r")).collect()
    assert queries.op1_warc_chunks
    return sorted(str(tuple(r)) for r in rows)


def test_hard_pages(spark, scratch):
    df = spark.createDataFrame([(*r, "extra", 1, 2) for r in HARD], "page_id long, url string, html string, sha string, id int, data int").repartition(3)
    manifest = W.write_archives(W.chunk_table(df, chunk=64), scratch if "://" in scratch else scratch, roll=200)
    assert manifest.agg(F.sum("n_records")).first()[0] == len(HARD)
    rows = W.read_archives(manifest, chunk=50)
    assert summary(rows) == expected([(i, h) for i, _, h in HARD])
    payloads = defaultdict(list)
    for r in rows.collect():
        assert len(r.data) <= 50
        payloads[(r.record, r.stated_digest, r.record_type, r.url)].append((r.chunk_no, bytes(r.data), r.bytes_so_far, r.digest_so_far))
    for (_, stated, kind, _), chunks in payloads.items():
        chunks.sort()
        whole = b""
        for k, (number, data, size, digest) in enumerate(chunks):
            whole += data
            assert (number, size, digest) == (k, len(whole), W.base32(hashlib.sha1(whole).digest()))
        if kind == "response":
            assert W.base32(hashlib.sha1(whole).digest()) == stated
        else:
            assert whole == b""


def test_pages(spark, rows_of):
    from vidpulse.llm import queries

    got = queries.op1_warc_chunks(spark, "/root/testdata/sf0.001").collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected([(i, h) for i, _, h in rows_of("pages")])


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = W.archive(df)
    assert manifest.count() == 0 and W.read_archives(manifest).count() == 0


def test_hot_payload(spark):
    df = spark.range(900).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("html"))
    got = summary(W.read_archives(W.archive(df), with_data=False))
    assert got == expected([(r.page_id, r.html) for r in df.collect()])


def test_damaged_archives_are_refused(spark, scratch):
    df = spark.createDataFrame([(1, "u", "payload " * 50)], "page_id long, url string, html string")
    name = W.write_archives(W.chunk_table(df), scratch).first().file
    with W.fs.FileSystem.from_uri(name)[0].open_input_stream(W.fs.FileSystem.from_uri(name)[1], compression=None) as f:
        raw = f.read()
    assert len(list(W.read_file(io.BytesIO(raw), 64))) == 7
    with pytest.raises(Exception):
        list(W.read_file(io.BytesIO(raw[: len(raw) // 2])))
    text = zlib.decompress(raw, 31).replace(b"payload payload", b"payload", 1)
    with pytest.raises(Exception):
        list(W.read_file(io.BytesIO(zlib.compress(text, wbits=31))))


def test_a_record_is_cut_chunk_by_chunk(spark, scratch):
    """A record of many chunks: no array of chunks in the plan, digest and bytes come back."""
    n = 3_000_001
    pages = spark.range(2).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.expr(f"repeat('é', {n})").alias("html"))
    chunks = W.chunk_table(pages, chunk=1000)
    plan = chunks._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence(0" in plan and "transform(" not in plan
    own = chunks.where("response").agg(F.count("*").alias("n"), F.max(F.octet_length("data")).alias("most"), F.sum(F.octet_length("data")).alias("all")).first()
    assert (own.n, own.most, own.all) == (-(-2 * n // 1000), 1000, 2 * n)
    back = W.read_archives(W.write_archives(W.chunk_table(pages), scratch), with_data=False).where("last and record_type = 'response'").collect()
    assert [(r.bytes_so_far, r.digest_so_far) for r in back] == [(2 * n, base64.b32encode(hashlib.sha1(("é" * n).encode()).digest()).decode())]
