"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters.

A row is (part, doc_id, local_start, n_tokens, ids).  Rows ascend by document
id over the files and in them; ORC writes the integers with its run-length
encoding, an index entry of minima and maxima for every ``ROWS`` rows and a
Bloom filter of document ids for the same rows.  A stripe can be read without
the others, so Spark splits large files at stripes; a look-up by id skips the
files, stripes and row groups whose statistics or filters exclude it.

The texts are range-partitioned by id once; each task encodes its range in
order and counts on from zero, so nothing waits for a total.  What lies before
a file is the sum of the tokens of the files before it, a table of one row a
file (``starts``); ``read_ids`` adds it.

The ``tokenizers`` library encodes a word when a worker does not remember it, as
the pre-tokenizer drops white space and no word depends on its neighbours.  A
block of texts is cut at once and Arrow numbers its words, so that Python meets
a word once a block, however often it stands there.

Defined results: null text counts as empty (one end id); null ids come first,
rows with one id are ordered by text hash and are told apart by their starts;
no rows give an empty table; further columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidpulse.llm.byte_bpe import byte_table
from vidpulse.llm.units import AgingMemory
from vidpulse.operators.prefix import running_sum

#: Rows of one index entry and Bloom filter.
ROWS = 1000
STRIPE_BYTES = 16 << 20
#: Text bytes of one Arrow batch of results and of a block whose words are numbered, about.
BATCH_BYTES = 8 << 20
#: Text bytes of a document that go into a block undivided.
PART_BYTES = 1 << 20
#: Bytes that a worker remembers of words as they stand, and of pieces of plain
#: texts (the older half is of words that may not come again).
WORD_BYTES = 32 << 20
CORE_BYTES = 96 << 20
_SPACE = re.compile(rb"\s")
_SCHEMA = "part int, doc_id {id}, local_start long, n_tokens long, ids array<int>"
#: Texts of ASCII and of letters that the normaliser lower-cases one by one and leaves composed.
_PLAIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-įı-ɏ]*")
#: Kinds of the bytes of such a text in lower case; bytes from 80 on are of letters.
_MARK, _GAP, _LETTER, _DIGIT = range(4)
_KINDS = np.full(256, _MARK, dtype=np.uint8)
_KINDS[list(b" \t\n\v\f\r")] = _GAP
_KINDS[ord("a") : ord("z") + 1] = _KINDS[128:] = _LETTER
_KINDS[ord("0") : ord("9") + 1] = _DIGIT
_SHORT = re.compile(rb"[stmd]|[rv]e|ll")


def _parts(data: bytes) -> Iterator[bytes]:
    """A long text in parts of about ``PART_BYTES`` that end at white space."""
    at = 0
    while at < len(data):
        stop = _SPACE.search(data, at + PART_BYTES) if at + PART_BYTES < len(data) else None
        end = stop.start() if stop else len(data)
        yield data[at:end]
        at = end


def _block(parts: Iterator[tuple[int, bytes]], most: int) -> list[tuple[int, bytes]]:
    """The next parts, of ``most`` bytes or little more."""
    block, size = [], 0
    for part in parts:
        block.append(part)
        size += len(part[1])
        if size >= most:
            break
    return block


def _is_plain(part: bytes) -> bool:
    """No letters but ASCII and Latin ones, no marks of special tokens."""
    return b"<|" not in part and (part.isascii() or _PLAIN.fullmatch(part.decode()) is not None)


def _cut(data: bytes) -> np.ndarray:
    """Where the pre-tokenizer's pieces of plain lower-case text begin, each
    with the white space before it: letters, one digit, marks, or a short form
    (``'s``, ``'re``) in place of marks that begin with its apostrophe."""
    octets = np.frombuffer(data, dtype=np.uint8)
    kinds = _KINDS[octets]
    begins = np.empty(len(octets), dtype=bool)
    begins[:1] = True
    begins[1:] = ((kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)) & (kinds[:-1] != _GAP)
    marks = np.flatnonzero(octets == ord("'"))
    for at in marks[(marks == 0) | (kinds[marks - 1] != _MARK)].tolist():
        short = _SHORT.match(data, at + 1)
        if short:
            begins[at + 1] = False
            begins[short.end() : short.end() + 1] = True
    return np.flatnonzero(begins)


class WordBpe:
    """Ids of texts by a tokenizer file whose pre-tokenizer drops white space.

    Texts of ASCII and Latin letters come apart into letters, single digits and
    marks, which the model reads lower-cased without the steps before it; the
    library encodes the words of other texts, cut at ASCII white space.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer, self.chars = Tokenizer.from_file(path), byte_table()
        self.cores = AgingMemory(self._core, CORE_BYTES)
        self.words = AgingMemory(self._word, WORD_BYTES)

    def _core(self, piece: bytes) -> bytes:
        """Ids of a piece of plain text, white space before it left out."""
        piece = piece.lstrip()
        if piece.isalpha():  # ASCII letters, which stand for themselves
            text = piece.decode()
        else:
            text = "".join([self.chars[b] for b in piece.decode().lower().encode()])
        ids = [t.id for t in self.tokenizer.model.tokenize(text)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _looked_up(self, memory: AgingMemory, units: pa.Array, ends: np.ndarray) -> list[bytes]:
        """Ids of the units up to each of ``ends``, every unit looked up once."""
        coded = units.dictionary_encode()
        known = pa.array([memory[u] for u in coded.dictionary.to_pylist()], type=pa.large_binary())
        ids = known.take(coded.indices)
        at = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy())])[ends].tolist()
        flat = memoryview(ids.buffers()[2] or b"")
        return [flat[a:b].tobytes() for a, b in zip([0, *at], at)]

    def _plain(self, parts: list[bytes]) -> list[bytes]:
        parts = [part.rstrip() for part in parts]  # a piece takes the white space before it
        data = b"\n".join(parts).lower()
        begins = _cut(data)
        bounds = np.append(begins, len(data)).astype(np.int64)
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        ends = np.cumsum([len(part) + 1 for part in parts]) - 1
        return self._looked_up(self.cores, units, np.searchsorted(bounds[1:], ends, side="right"))

    def _mixed(self, parts: list[bytes]) -> list[bytes]:
        words = pc.ascii_split_whitespace(pa.array(parts, type=pa.string()))
        return self._looked_up(self.words, words.flatten().cast(pa.binary()), words.offsets.to_numpy()[1:])

    def _encode_block(self, parts: list[bytes]) -> list[bytes]:
        plain = [_is_plain(part) for part in parts]
        of_plain = iter(self._plain([part for part, p in zip(parts, plain) if p]) if any(plain) else ())
        of_mixed = iter(self._mixed([part for part, p in zip(parts, plain) if not p]) if not all(plain) else ())
        return [next(of_plain if p else of_mixed) for p in plain]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32."""
        ids: list[list[bytes]] = [[] for _ in texts]
        parts = ((at, part) for at, text in enumerate(texts) for part in _parts(text.encode()))
        while block := _block(parts, BATCH_BYTES):
            for (at, _), some in zip(block, self._encode_block([part for _, part in block])):
                ids[at].append(some)
        return [b"".join(some) for some in ids]

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian uint32."""
        return self.encode_all([text])[0]


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One encoder per worker process."""
    return WordBpe(path)


def encode_in_order(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of the file format, ascending by id over the partitions.

    Ties are ordered by text hash; a row number spreads rows that are equal
    in both, which are interchangeable, over partitions.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "hash", "row"]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))
    ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, start = load(tokenizer), struct.pack("<I", end_id), 0
        for batch in batches:
            step = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.column(2).nbytes)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = [i + end for i in bpe.encode_all([t or "" for t in part.column(2).to_pylist()])]
                sizes = np.array([len(i) // 4 for i in ids], dtype=np.int64)
                ends = np.cumsum(sizes)
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(start + ends - sizes), pa.array(sizes), lists],
                    names=["part", "doc_id", "local_start", "n_tokens", "ids"])
                start += int(sizes.sum())

    return ranged.mapInArrow(run, _SCHEMA.format(id=id_type))


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> None:
    """Encode ``docs`` and write the ORC files below ``path``."""
    rows = encode_in_order(docs, tokenizer, end_id, id_col, text)
    (rows.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(ROWS)).option("orc.create.index", "true")
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("compression", "zstd").orc(path))


def starts(spark: SparkSession, path: str) -> DataFrame:
    """Per file (part): its tokens and those of all files before it, from the
    two columns that say where its documents end."""
    files = spark.read.orc(path).groupBy("part").agg(F.max(F.col("local_start") + F.col("n_tokens")).alias("tokens"))
    return running_sum(files, ["part"], weight=F.col("tokens"), out="upto").select("part", "tokens", (F.col("upto") - F.col("tokens")).alias("before"))


def read_ids(spark: SparkSession, path: str, columns: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it) and
    ``columns``.  ``starts`` has one row a file, so it goes to the files."""
    return spark.read.orc(path).join(F.broadcast(starts(spark, path)), "part").select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), *columns)


def look_up(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The documents of a few ids: the scan skips stripes and row groups by
    minima, maxima and Bloom filters of the id."""
    return read_ids(spark, path).where(F.col("doc_id").isin(doc_ids))


def ids_crc32(table: DataFrame) -> DataFrame:
    """Per document of ``read_ids``: its CRC-32 over the ids as little-endian uint32."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ends = batch.column(3), batch.column(3).offsets.to_numpy()
            flat = memoryview(ids.values.to_numpy().astype("<i4", copy=False)).cast("B")
            crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, type=pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = table.select("doc_id", "start", "n_tokens", "ids")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")
