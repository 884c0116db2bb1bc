import random
import struct
import zlib

import public_tokenizers
import pyarrow.orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vidpulse.llm import token_orc as O
from vidpulse.llm.units import AgingMemory, UnitMemory

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def brute(library, rows, end=2):
    """rows: (doc_id, text) in file order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def stored(spark, scratch, docs):
    O.write_ids(docs, scratch, PATH, end_id=2)
    return O.ids_crc32(O.read_ids(spark, scratch)).orderBy("start").collect()


@pytest.fixture()
def path(spark):
    from vidpulse.llm.common import scratch_path

    return scratch_path(spark, "orc-test")


def test_words_equal_whole_texts(library):
    parts = ["Hello", "don't", "I'LL", "x's.", "J̌", "T̈", "É", "é", "ΣΑΣ", "İ", "ﬁ", "12a3", "a.b,c", "...", "!?", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>.",
             "漢字かな", "\U0001f600", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", " ", " ", "́", "\x00", "#", "á.", "'", "'s", "Die,", "K"]
    rng, bpe = random.Random(5), O.WordBpe(PATH)
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == struct.pack(f"<{len(ids)}I", *ids), repr(text)


def test_long_texts_go_part_by_part(library, monkeypatch):
    monkeypatch.setattr(O, "PART_BYTES", 10)
    text = "Some words,  and more of them\nin é lines. " * 20
    ids = library.encode(text, add_special_tokens=False).ids
    assert O.WordBpe(PATH).encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_starts_follow_the_ids_over_files(spark, path, documents, library):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    got = stored(spark, path, documents.repartition(7))
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == brute(library, rows)
    assert spark.read.orc(path).select("part").distinct().count() > 1


def test_edge_documents(spark, path, edge_docs, library):
    got = [tuple(r) for r in stored(spark, path, edge_docs)]
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    hashes = {(r["doc_id"], r["text"]): r["h"] for r in edge_docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashes[r]))
    assert got == brute(library, rows)


def test_no_documents(spark, path, no_docs):
    assert stored(spark, path, no_docs) == []


def test_one_row_for_a_third_of_the_table_spreads_over_files(spark, path):
    same = spark.range(400).select(F.lit(5).cast("long").alias("doc_id"), F.lit("the same words").alias("text"))
    docs = same.union(spark.range(800).select("id", F.concat(F.lit("w "), "id")))
    got = stored(spark, path, docs)
    assert len(got) == 1200 and [r["start"] for r in got[1:]] == [r["start"] + r["n_tokens"] for r in got[:-1]]
    assert spark.read.orc(path).where("doc_id = 5").select("part").distinct().count() > 1


def test_files_have_row_indexes_and_filters_that_prune(spark, path, tmp_path):
    docs = spark.range(0, 40_000, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text")).coalesce(1)
    O.write_ids(docs, path, PATH, end_id=2)
    found = O.look_up(spark, path, [20_000, 20_001])
    rows = found.collect()
    assert [r["doc_id"] for r in rows] == [20_000]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id, [20000,20001])" in plan or "In(doc_id" in plan
    scan = spark.read.orc(path).where(F.col("doc_id") == 20_000)  # what leaves the scan is one row group, not the file
    scan.collect()
    node = scan._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    assert 0 < node.metrics().apply("numOutputRows").value() <= 2 * O.ROWS
    absent = spark.read.orc(path).where(F.col("doc_id") == 20_001)  # inside minima and maxima, not in the filter
    absent.collect()
    node = absent._jdf.queryExecution().executedPlan()
    while node.children().size():
        node = node.children().head()
    assert node.metrics().apply("numOutputRows").value() == 0
    files = [f for f in spark.read.orc(path).inputFiles()]
    assert sum(pyarrow.orc.ORCFile(f.removeprefix("file:").replace("//", "/")).nrows for f in files) == 20_000


def test_memory_stays_within_its_bytes():
    memory = UnitMemory(lambda unit: unit * 2, most_bytes=50_000)
    for k in range(50):
        for unit in [f"{k}-{j}".encode() for j in range(100)] + [b"x" * 100_000]:
            assert memory[unit] == unit * 2
            assert memory.used <= 50_000 and b"x" * 100_000 not in memory


def test_aging_memory_keeps_what_comes_back_within_its_bytes():
    asked = []
    memory = AgingMemory(lambda unit: asked.append(unit) or unit * 2, most_bytes=50_000)
    for k in range(3000):
        assert memory[b"often"] == b"oftenoften" and memory[b"%d" % k] == b"%d%d" % (k, k)
        assert sum(200 + len(u) + len(v) for u, v in [*memory.items(), *memory.older.items()]) <= 50_000
    assert asked.count(b"often") == 1 and len(asked) == 3001
    assert memory[b"x" * 100] == b"x" * 200 and b"x" * 100 not in memory


def test_a_worker_remembers_little_of_texts_with_new_words(library):
    """Six workers of an executor remembered up to 512 MB each."""
    bpe = O.WordBpe(PATH)
    assert bpe.words.most_bytes + bpe.cores.most_bytes <= 128 << 20
    bpe.words.most_bytes = bpe.cores.most_bytes = 20_000
    rng = random.Random(2)
    for _ in range(300):
        text = " ".join(rng.choice(["The", "end.", "été,", "x1;", f"w{rng.randrange(10**6)}.", "<|endoftext|>", "...", "a.b?"]) for _ in range(40))
        text = text if rng.randrange(2) else text.encode("ascii", "ignore").decode().replace("<|", "<")
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_a_block_looks_a_word_up_once(library):
    """Every occurrence was looked up by itself: 489 CPU seconds a GB."""
    class Counting(AgingMemory):
        asked = 0

        def __getitem__(self, unit):
            Counting.asked += 1
            return super().__getitem__(unit)

    for text in ("The cat's 2 hats, née Été. " * 500, "漢字 and\tthe cat. " * 500):
        bpe = O.WordBpe(PATH)
        bpe.words, bpe.cores, Counting.asked = Counting(bpe.words.work, 1 << 20), Counting(bpe.cores.work, 1 << 20), 0
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == struct.pack(f"<{len(ids)}I", *ids) and 0 < Counting.asked <= 24


@pytest.mark.parametrize("block", [1, 60, 8 << 20])
def test_blocks_of_texts_equal_the_library(library, monkeypatch, block):
    monkeypatch.setattr(O, "BATCH_BYTES", block)
    monkeypatch.setattr(O, "PART_BYTES", 20)
    parts = ["it", "'s", "'S", "'", "''", "'re", "'r", "'LL", "'send", "!", "!'s", "12", "7", "é", "É", "ȺB", "ß", "Ŀ", "a", "Word", ".", "...", "\x00", "\x1c", "\x7f", "_", "`", "@[", "{",
             " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x85", "\xa0", "İ", "漢", "\u0301", "×", "<|endoftext|>", "<|", "</w>"]
    rng, bpe = random.Random(7), O.WordBpe(PATH)
    for most in (29, 36, len(parts)):  # plain texts only in the first two rounds
        for _ in range(150):
            texts = ["".join(rng.choice(parts[: most if rng.randrange(3) else 36]) for _ in range(rng.choice([0, 1, 2, 9, 30]))) for _ in range(12)]
            want = [library.encode(text, add_special_tokens=False).ids for text in texts]
            got = [list(struct.unpack(f"<{len(ids) // 4}I", ids)) for ids in bpe.encode_all(texts)]
            assert got == want, [(t, w, g) for t, w, g in zip(texts, want, got) if w != g][:1]
