import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vidpulse.llm import token_align as T
from vidpulse.llm.common import written

PATHS = [public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}
    vocabulary = json.load(open(PATHS[0]))["model"]["vocab"]
    return a, {k: bytes(byte[c] for c in t) for t, k in vocabulary.items()}, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def align(libraries, text):
    """Ids, groups and links by comparing all ranges."""
    a, bytes_a, b = libraries
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    piece = lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
    cut_a, cut_b = [bytes_a[k] for k in ids_a], [piece(k) for k in ids_b]
    data = (" " + text).encode()
    if b"".join(cut_a) != data or b"".join(cut_b) != data:
        return None
    sa, sb = spans(cut_a), spans(cut_b)
    ends = sorted({e for _, e in sa} & {e for _, e in sb})
    within = lambda ids, own, lo, hi: ",".join(str(k) for k, (_, e) in zip(ids, own) if lo < e <= hi)
    groups = ";".join(f"{within(ids_a, sa, lo, hi)}|{within(ids_b, sb, lo, hi)}" for lo, hi in zip([0, *ends], ends))
    links = [(x, y) for x, (p, q) in zip(ids_a, sa) for y, (r, s) in zip(ids_b, sb) if p < s and r < q]
    return ids_a, ids_b, len(ends), links, groups


def brute(libraries, rows):
    found = [(i, align(libraries, t)) for i, t in rows]
    counts = Counter(link for _, f in found if f for link in f[3])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, "", 0, 0))
        else:
            links = f[3]
            out.append((i, len(f[0]), len(f[1]), f[2], len(links), hashlib.sha256(f[4].encode()).hexdigest(),
                        sum(counts[link] == most[link[1]] for link in links), sum(counts[link] for link in links)))
    return sorted(out, key=str)


def scored(docs, **how):
    return sorted(map(tuple, T.score(written(T.align(docs, *PATHS, **how), "align-test")).select(
        "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum").collect()), key=str)


def test_gallop_finds_the_first_place_not_below():
    rng = random.Random(3)
    for _ in range(500):
        longer = sorted(rng.sample(range(200), rng.randrange(1, 60)))
        values = [rng.randrange(longer[-1] + 1) for _ in range(20)]
        first = [rng.randrange(sum(x < v for x in longer) + 1) for v in values]
        last = [rng.randrange(sum(x < v for x in longer), len(longer)) for v in values]
        got = T.gallop(*(np.array(x) for x in (values, longer, first, last)))
        assert got.tolist() == [max(f, sum(x < v for x in longer)) for v, f in zip(values, first)]


def test_groups_and_links_equal_all_overlapping_ranges():
    rng = random.Random(4)
    for _ in range(1000):
        sizes = [[], []]
        units = [[], []]
        for _ in range(rng.randrange(1, 6)):  # units end together
            n = rng.randrange(1, 20)
            for k in range(2):
                cuts = [0, *sorted({*rng.sample(range(1, n + 1), rng.randrange(0, n)), n})]
                sizes[k] += [q - p for p, q in zip(cuts, cuts[1:])]
                units[k].append(len(cuts) - 1)
        ends = T.Ends(*map(np.array, (*sizes, *units)))
        cuts = [np.cumsum(s).tolist() for s in sizes]
        starts = [[0, *c[:-1]] for c in cuts]
        want = [(x, y) for x in range(len(cuts[0])) for y in range(len(cuts[1])) if starts[0][x] < cuts[1][y] and starts[1][y] < cuts[0][x]]
        n, a, b = ends.links()
        assert list(zip(a.tolist(), b.tolist())) == want and n.tolist() == [sum(x == k for x, _ in want) for k in range(len(cuts[0]))]
        assert [cuts[0][r - 1] for r in ends.upto_a] == sorted({*cuts[0]} & {*cuts[1]}) == [cuts[1][r - 1] for r in ends.upto_b]


PIECES = ["Hello", "don't", "x's", "É", "é", "漢字", "\U0001f600", "▁", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", " ", " ", " ", "  ", "   ", "\n", "\n ", "\t", "\r\n", "\x0b", "\x1c",
          "\x85", "\xa0", " ", " ", "́", "12345", "...", ".", "the", "words", "Schberzu", "ß", "\x00", "=", "----", "​"]


def test_units_equal_whole_texts(libraries, monkeypatch):
    rng, own = random.Random(6), T.Aligner(*PATHS)
    for k in range(4000):
        monkeypatch.setattr(T, "PART", rng.choice([5, 1 << 20]))
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14)))
        got, want = next(iter(own.documents([text]))), align(libraries, text)
        assert got.groups == ("" if want is None else want[4]), repr(text)
        own.most_bytes = rng.choice([0, 1 << 30])  # forgetting between texts changes nothing
        assert (got.n_a, got.n_b, got.n_groups, got.n_links) == ((0, 0, 0, 0) if want is None else (len(want[0]), len(want[1]), want[2], len(want[3])))


def test_scores_equal_brute_force_over_many_blocks(spark, libraries):
    rng = random.Random(8)
    rows = [(k, "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 60)))) for k in range(300)] + [(900 + k, "the same words don't") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert scored(docs, block_size=500) == brute(libraries, rows)


def test_documents_and_edges(spark, libraries, documents, edge_docs, no_docs):
    short = documents.where(F.length("text") < 1500)  # the comparison of all ranges is slow
    assert scored(short) == brute(libraries, [(r["doc_id"], r["text"]) for r in short.collect()])
    few = edge_docs.where("text is null or length(text) < 1000")
    assert scored(few) == brute(libraries, [(r["doc_id"], r["text"]) for r in few.collect()])
    assert len(scored(edge_docs)) == edge_docs.count()
    assert scored(no_docs) == []


def test_groups_on_request(spark):
    docs = spark.createDataFrame([(1, "the words")], "doc_id long, text string")
    row = T.align(docs, *PATHS, with_groups=True).first()
    assert row["groups"].count(";") + 1 == row["n_groups"]
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"]
