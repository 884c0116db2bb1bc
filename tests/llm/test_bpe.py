"""Byte-level BPE against tiktoken."""

import base64
import hashlib
import random
import struct
import tracemalloc

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from vidpulse.llm import byte_bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def oracle():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.load(RANKS, P.PATTERN)


def check(df, oracle):
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    want = []
    for i, t in rows:
        ids = oracle.encode_ordinary(t)
        raw = struct.pack(f"<{len(ids)}I", *ids)
        want.append(str((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), raw)))
    got = byte_bpe.encode(df, RANKS, P.PATTERN).collect()
    assert sorted(str((r.id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.ids))) for r in got) == sorted(want)
    assert all(r.round_trip for r in got)


def test_documents(documents, oracle):
    check(documents, oracle)


def test_edge_cases(edge_docs, oracle):
    check(edge_docs, oracle)


def test_pieces_of_rows(spark, edge_docs, no_docs, oracle):
    """Tokens with offsets as a DataFrame; a split character belongs to the token that completes it."""
    odd = spark.createDataFrame([(1, "\U0001f389中文 \U0001f9ff x\u0378é"), (2, None), (3, "नमस्ते the end")], "doc_id long, text string")
    for df in (odd, edge_docs, no_docs):
        want = sorted(str((r.doc_id, r.text or "", oracle.encode_ordinary(r.text or ""))) for r in df.collect())
        got = byte_bpe.encode_pieces(df, RANKS, P.PATTERN).collect()
        assert sorted(str((r.id, "".join(p.text for p in r.pieces), [p.token for p in r.pieces])) for r in got) == want
        for r in got:
            whole = "".join(p.text for p in r.pieces)
            assert all(whole[p.start:p.end] == p.text for p in r.pieces)
            assert [p.end for p in r.pieces][:-1] == [p.start for p in r.pieces][1:]


def test_nothing(no_docs):
    assert byte_bpe.encode(no_docs, RANKS, P.PATTERN).count() == 0


def test_fuzz(bpe, oracle):
    rnd = random.Random(4)
    parts = [" ", "\n", "\t", "\x0b", "\x1c", "\x85", " ", "　", " ", "\r\n", "a", "aa", "=", "é", "ß", "中", "文", "\U0001f389", "́",
             "1", "23", "'s", "'ll", "the", " the", "_", "\x00", "‍", "Ⅷ", "²", "नमस्ते", "العربية", "Ωλ", ".", "!?"]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) * rnd.choice([1, 1, 2, 3, 9, 40]) for _ in range(rnd.randint(1, 12)))
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == oracle.encode_ordinary(text)
        assert bpe.decode(bpe.encode(text)) == text.encode()


def test_long_texts_go_by_parts(bpe, oracle, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART_UNITS", 50)
    text = " ".join(f"word{k}  \n\n x" for k in range(400)) + "a" * 5000
    assert np.frombuffer(bpe.encode(text), "<u4").tolist() == oracle.encode_ordinary(text)
    assert bpe.decode(bpe.encode(text)) == text.encode()


def test_pieces_complete_split_characters(bpe):
    text = "a\U0001f389中é zé"
    found = list(bpe.pieces(bpe.encode(text)))
    assert "".join(p for _, p, _, _ in found) == text
    assert all(text[a:b] == p for _, p, a, b in found)
    assert any(p == "" for _, p, _, _ in found)  # a token that ends inside a character


def test_byte_table_is_one_to_one():
    table = byte_bpe.byte_table()
    assert len(set(table)) == 256 and table[ord("A")] == "A" and table[32] == "Ġ"


def test_ends_and_split_characters(spark, edge_docs, bpe):
    """Offsets of the operator against decoding token by token."""
    odd = spark.createDataFrame([(1, "\U0001f389中文 \U0001f9ff x\u0378é"), (2, None), (3, "नमस्ते the end"), (4, "a"), (5, "\u0378"), (6, "\U0001f9ff" * 50)], "doc_id long, text string")
    for df in (odd, edge_docs):
        for r in byte_bpe.encode(df, RANKS, P.PATTERN).collect():
            pieces = list(bpe.pieces(bytes(r.ids)))
            assert np.frombuffer(bytes(r.ends), "<u4").tolist() == [end for *_, end in pieces]
            split, at, owner = set(), 0, {}
            for k, token in enumerate(np.frombuffer(bytes(r.ids), "<u4").tolist()):
                for _ in bpe.tokens[token]:
                    owner[at] = k
                    at += 1
            at = 0
            for place, c in enumerate("".join(t for _, t, *_ in pieces)):
                n = len(c.encode())
                if len({owner[at + j] for j in range(n)}) > 1:
                    split.add(place)
                at += n
            assert r.n_split == len(split)


def test_memory_on_text_without_spaces():
    """Long units are not remembered, short ones within the bytes."""
    own = byte_bpe.ByteBpe(RANKS, P.PATTERN)
    rng = random.Random(1)
    letters = [chr(0x4E00 + k) for k in range(3000)]
    texts = [" ".join("".join(rng.choices(letters, k=2000)) for _ in range(20)) for _ in range(60)]
    own.encode(texts[0])
    tracemalloc.start()
    for t in texts:
        own.encode(t)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 5 << 20  # 1,200 units of 2,000 characters: 26 MB if remembered
    assert all(len(u) <= byte_bpe.SHORT for u in own.known)


def test_memory_stays_within_its_bytes(monkeypatch, oracle):
    monkeypatch.setattr(byte_bpe, "KNOWN_BYTES", 20_000)
    own, rng = byte_bpe.ByteBpe(RANKS, P.PATTERN), random.Random(2)
    for _ in range(40):
        text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(50))
        assert own.encode(text) == struct.pack(f"<{len(oracle.encode_ordinary(text))}I", *oracle.encode_ordinary(text))
        assert own.used <= 20_000
