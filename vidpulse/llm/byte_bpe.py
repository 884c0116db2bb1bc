"""Byte-level BPE: the ``tokenizers`` library over Arrow batches.

The rank file becomes a ``tokenizers`` model: each byte is written as one
printable character (the usual byte table), a token as a string of them.
Every way to cut a token into two tokens is a merge, in rank order, so the
library merges what the rank file merges.  Texts are cut into units that no
piece of the split pattern crosses; the library encodes each distinct unit,
and a worker remembers short ones within a byte budget, as words repeat.

Decoding maps ids to their byte strings by the reversed byte table.  Offsets
count characters: a character whose bytes are split over tokens belongs to the
token that completes it (``ends``; ``encode`` gives them with the ids).
``pieces`` decodes token by token, ``encode_pieces`` over Arrow batches: per
row its tokens with their text and offsets.

Defined results: null text counts as empty and has no ids; repeated rows are
encoded alike; no rows give no rows; further columns are ignored, or passed
through by ``encode``.
"""

from __future__ import annotations

import base64
import codecs
import functools
import hashlib
import itertools
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space as the split pattern sees it (Unicode White_Space).
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A word with the one space before it, or white space: no piece of the split
#: pattern crosses from one unit to the next, so units are encoded apart.
UNIT = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: Units (and ids to decode) handled at once; long texts go part by part.
PART_UNITS = 100_000
#: Bytes that a worker's remembered units take at most (by estimate), and the
#: longest unit that is remembered: text without spaces makes long units that
#: are never met again.
KNOWN_BYTES, SHORT = 256 << 20, 64


def byte_table() -> list[str]:
    """Character for each byte: printable Latin-1 as itself, the others moved up to 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class ByteBpe:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        chars = byte_table()
        text = lambda token: "".join(chars[b] for b in token)
        merges = [
            (text(token[:k]), text(token[k:]))
            for token in sorted(ranks, key=ranks.get) for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks]
        model = models.BPE(vocab={text(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        byte_of = {c: b for b, c in enumerate(chars)}
        self.tokens = {k: bytes(byte_of[c] for c in t) for t, k in self.tokenizer.get_vocab().items()}
        top = max(self.tokens) + 1
        self.sizes = np.array([len(self.tokens.get(k, b"")) for k in range(top)], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.tokens.get(k, b"") for k in range(top)), dtype=np.uint8)
        self.known: dict[str, bytes] = {}  # ids of short units seen by this worker
        self.used = 0

    def _of_units(self, units: list[str]) -> bytes:
        """Ids of units one after the other."""
        found = list(map(self.known.get, units))
        if None not in found:
            return b"".join(found)
        missing = list(dict.fromkeys(u for u, ids in zip(units, found) if ids is None))
        fresh: dict[str, bytes] = {}
        for at in range(0, len(missing), 1024):
            some = missing[at : at + 1024]
            for unit, own in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                fresh[unit] = struct.pack(f"<{len(own.ids)}I", *own.ids)
        out = b"".join([fresh[u] if ids is None else ids for u, ids in zip(units, found)])
        for unit, ids in fresh.items():
            if len(unit) <= SHORT:
                cost = 250 + 4 * len(unit) + len(ids)
                if self.used + cost > KNOWN_BYTES:
                    self.known.clear()
                    self.used = 0
                self.known[unit] = ids
                self.used += cost
        return out

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian uint32."""
        units, out = UNIT.finditer(text), []
        while part := [m.group() for m in itertools.islice(units, PART_UNITS)] if len(text) > PART_UNITS else UNIT.findall(text):
            out.append(self._of_units(part))
            if len(text) <= PART_UNITS:
                break
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the ids, by the reversed byte table."""
        found = np.frombuffer(ids, dtype="<u4")
        return b"".join([self._decode(found[at : at + PART_UNITS]) for at in range(0, len(found), PART_UNITS)])

    def _decode(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()

    def ends(self, ids: bytes, decoded: bytes) -> np.ndarray:
        """Characters that are complete after each token of ``decoded`` (the
        tokens' bytes, which are UTF-8 as a whole)."""
        data = np.frombuffer(decoded, dtype=np.uint8)
        last = np.ones(len(data), dtype=bool)  # the byte that completes a character: one begins after it
        last[:-1] = data[1:] & 0xC0 != 0x80
        upto = np.concatenate([[0], np.cumsum(last)])
        return upto[np.cumsum(self.sizes[np.frombuffer(ids, dtype="<u4")])].astype("<u4")

    def split_characters(self, ids: bytes, decoded: bytes, ends: np.ndarray) -> int:
        """Characters whose bytes lie in more than one token."""
        if len(decoded) == (int(ends[-1]) if len(ends) else 0):
            return 0  # one byte each
        data = np.frombuffer(decoded, dtype=np.uint8)
        stops = np.cumsum(self.sizes[np.frombuffer(ids, dtype="<u4")])[:-1]
        return len(np.unique(ends[:-1][data[stops] & 0xC0 == 0x80]))  # a token begins inside the character

    def pieces(self, ids: bytes) -> Iterator[tuple[int, str, int, int]]:
        """(id, text, start, end): the characters that each token completes,
        with code-point offsets."""
        reader, at = codecs.getincrementaldecoder("utf-8")("replace"), 0
        for k in np.frombuffer(ids, dtype="<u4").tolist():
            part = reader.decode(self.tokens[k])
            yield k, part, at, at + len(part)
            at += len(part)


@functools.lru_cache(maxsize=2)
def load(ranks_path: str, pattern: str) -> ByteBpe:
    """One model per worker process."""
    return ByteBpe(ranks_path, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row: id, ids and ends (binary, little-endian uint32; null if
    ``with_ids`` is off), n_tokens, ids_sha256, decoded_sha256, round_trip
    (decoded bytes equal the text) and n_split: characters whose bytes lie in
    more than one token.  ``ends``: the characters complete after each token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[list] = [[], [], [], [], [], [], []]
                for t in part.column(1).to_pylist():
                    ids = bpe.encode(t or "")
                    decoded = bpe.decode(ids)
                    ends = bpe.ends(ids, decoded)
                    for column, value in zip(out, (
                            ids if with_ids else None, ends.tobytes() if with_ids else None, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                            hashlib.sha256(decoded).hexdigest(), decoded == (t or "").encode(), bpe.split_characters(ids, decoded, ends))):
                        column.append(value)
                kinds = (pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, type=k) for c, k in zip(out, kinds))],
                    names=["id", "ids", "ends", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "n_split"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, ends binary, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, n_split long")


def encode_pieces(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id and pieces (token, text, start, end) in order, with code-point offsets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(ranks_path, pattern)
        piece = pa.struct([("token", pa.int64()), ("text", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for at in range(batch.num_rows):  # the pieces of one text at a time
                part = batch.slice(at, 1)
                found = pa.array(list(bpe.pieces(bpe.encode(part.column(1)[0].as_py() or ""))), type=piece)
                pieces = pa.ListArray.from_arrays(pa.array([0, len(found)], type=pa.int32()), found)
                yield pa.RecordBatch.from_arrays([part.column(0), pieces], names=["id", "pieces"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, pieces array<struct<token:long,text:string,start:long,end:long>>")
