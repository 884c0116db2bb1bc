"""Cross-tokenizer alignment: galloping intersection of token ends.

Two tokenizers cut the same bytes.  Where a token of both ends, a group ends:
the shorter list of end offsets drives an exponential and then binary search
into the longer one, the common ends slice the groups, and the ranks on both
sides of an end give for every token the range of tokens that it overlaps.

Byte-level BPE (A) reads a space and the text; the piece model (B) reads the
text and adds the space.  Neither has a token over the end of a word before a
space, which is checked in the vocabulary of B, so an end of a word is an end
of both and each distinct word (with the white space before it) is aligned
once per worker.

A pair's count is corpus-wide.  It must meet every document that holds the
pair, without sending every link through a shuffle:

1. documents are aligned in blocks of ``BLOCK`` characters; a document's
   pairs, one for each link of its distinct words, stay with it with their numbers;
2. pairs are summed per block, then over blocks;
3. the distinct (block, pair) rows meet the sums (``lane_lookup``: a pair that
   is in every block is spread over lanes);
4. blocks and their pairs' sums are cogrouped; a block's distinct pairs are
   bounded by its bytes.

Defined results: null and empty texts, and texts whose joined token bytes
differ from the space and the text, have no tokens (zeros, empty string);
repeated rows are aligned alike and each counts; no rows give no rows; further
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidpulse.llm.common import lane_lookup, written

#: Characters of text in one block.
BLOCK = 4 << 20
#: Characters of a text that are cut into units at once.
PART = 1 << 20
#: Ids of B are below this, so a pair is one integer.
WIDE = 1 << 15


def gallop(values: np.ndarray, ascending: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Per value the first place from ``first`` to ``last`` (both included)
    whose entry in ``ascending`` is not below it: steps double from ``first``
    until they pass the value, then a binary search between the last two.
    All values advance together.  The entry at ``last`` is not below."""
    low, high = first.copy(), last.copy()
    at, step = np.arange(len(values)), 1
    while len(at):
        probe = first[at] + step
        within = probe < last[at]
        at, probe = at[within], probe[within]
        below = ascending[probe] < values[at]
        high[at[~below]] = probe[~below]
        at = at[below]
        low[at] = probe[below]
        step *= 2
    while (open_ := low < high).any():
        middle = (low + high) // 2
        below = open_ & (ascending[middle] < values)
        low = np.where(below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)
    return low


def _of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of each unit, per token of the unit."""
    ends = np.cumsum(sizes)
    return ends - sizes, ends - 1


class Ends:
    """Token ends of consecutive units, in tokens of A and B, and what they share."""

    def __init__(self, size_a: np.ndarray, size_b: np.ndarray, units_a: np.ndarray, units_b: np.ndarray) -> None:
        """``size_*``: bytes of each token; ``units_*``: tokens of each unit."""
        self.size_a, self.units_a, self.units_b = size_a, units_a, units_b
        self.a, self.b = np.cumsum(size_a), np.cumsum(size_b)
        swapped = len(self.a) > len(self.b)
        short, long = (self.b, self.a) if swapped else (self.a, self.b)
        of_short, of_long = (units_b, units_a) if swapped else (units_a, units_b)
        first, last = (np.repeat(x, of_short) for x in _of(of_long))
        place = gallop(short, long, first, last)
        common = long[place] == short
        self.unit = np.repeat(np.arange(len(of_short)), of_short)[common]  # of each group
        ranks = np.flatnonzero(common) + 1, place[common] + 1
        #: Tokens up to the end of each group.
        self.upto_a, self.upto_b = ranks[::-1] if swapped else ranks

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Links per token of A, and all links as token ranks (a, b): the ranks
        of a token's start and end among the other ends bound its range."""
        first = np.searchsorted(self.b, self.a - self.size_a, side="right")
        n = np.searchsorted(self.b, self.a, side="left") - first + 1
        a = np.repeat(np.arange(len(n)), n)
        return n, a, np.arange(len(a)) + np.repeat(first - np.cumsum(n) + n, n)


class Names:
    """Decimal ids followed by a sign, as object arrays to pick from."""

    def __init__(self, top: int) -> None:
        self.comma, self.bar, self.semicolon = (np.array([f"{k}{sign}" for k in range(top)], dtype=object) for sign in ",|;")

    def interleaved(self, ends: Ends, a: np.ndarray, b: np.ndarray) -> list[str]:
        """The ids of A and B group by group, each with the sign after it."""
        group_a = np.searchsorted(ends.upto_a, np.arange(len(a)), side="right")
        group_b = np.searchsorted(ends.upto_b, np.arange(len(b)), side="right")
        before_b = np.concatenate([[0], ends.upto_b[:-1]])
        out = np.empty(len(a) + len(b), dtype=object)
        last_a, last_b = np.isin(np.arange(len(a)) + 1, ends.upto_a), np.isin(np.arange(len(b)) + 1, ends.upto_b)
        out[np.arange(len(a)) + before_b[group_a]] = np.where(last_a, self.bar[a], self.comma[a])
        out[np.arange(len(b)) + ends.upto_a[group_b]] = np.where(last_b, self.semicolon[b], self.comma[b])
        return out.tolist()


class Document(NamedTuple):
    """One text: its sums, groups, the pairs of its distinct units and how
    often each stands (int32 each; a pair that two units hold comes twice)."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    groups_sha256: str
    pairs: bytes
    numbers: bytes


NO_TOKENS = Document(0, 0, 0, 0, "", "", b"", b"")


class Units(dict):
    """Place of each known unit; a new one gets the next place and waits in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.new.append(unit)
        self[unit] = place = len(self)
        return place


class Aligner:
    """Both tokenizers and the alignment of units.

    What is known of a unit stands at its place in ``numbers`` (n_a, n_b,
    n_groups, n_links), ``texts`` (its groups) and ``pairs`` (a * WIDE + b of
    its links, from ``first`` on).  All of it is dropped between two texts once
    it takes more than ``most_bytes`` by estimate.
    """

    #: The end of a word before white space that a word follows, which starts with a space.
    CUT = re.compile(r"(?<=\S)(?= \s*\S)")
    #: White space before a space or at the end: words are not simply what stands between spaces.
    UNEVEN = re.compile(r"\s(?: |\Z)")
    PLAIN = re.compile(" [A-Za-zÀ-ÖØ-öø-ɏ]+")

    def __init__(self, path_a: str, path_b: str, most_bytes: int = 128 << 20) -> None:
        import sentencepiece
        from tokenizers import Tokenizer
        from vidpulse.llm.byte_bpe import byte_table

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.most_bytes = most_bytes
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        chars = byte_table()
        byte_of, self.chars = {c: bytes([b]) for b, c in enumerate(chars)}, chars
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.bytes_a[k] = b"".join(byte_of[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if len(pieces) > WIDE:
            raise ValueError("more pieces than a pair can hold")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.names = Names(max(len(self.bytes_a), len(self.bytes_b)))
        #: Whether no piece goes over the end of a word, so that words can be encoded apart.
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self._forget()

    def _forget(self) -> None:
        self.units_known, self.used = Units(), 0
        self.numbers, self.first, self.texts = np.zeros((1024, 4), np.int64), np.zeros(1024, np.int64), []
        self.pairs, self.n_pairs = np.zeros(4096, "<i4"), 0

    def parts(self, text: str) -> Iterator[str]:
        """The space and the text, in parts of about ``PART`` characters that end where units end."""
        text, at = " " + text, 0
        while at < len(text):
            cut = self.CUT.search(text, at + PART) if self.apart and at + PART < len(text) else None
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end

    def units(self, part: str) -> list[str]:
        """A part, cut before each space that follows a word."""
        if not self.apart:
            return [part]
        if self.UNEVEN.search(part):
            return self.CUT.split(part)
        return [" " + w for w in part[1:].split(" ")]

    def _ids_a(self, units: list[str]) -> list[list[int]]:
        """A space and Latin letters are one piece of the split pattern, which
        the model reads without the steps before it."""
        chars, tokenize = self.chars, self.a.model.tokenize
        out: list = [[t.id for t in tokenize("".join([chars[b] for b in u.encode()]))] if self.PLAIN.fullmatch(u) else None for u in units]
        others = [u for u, ids in zip(units, out) if ids is None]
        rest = iter(self.a.encode_batch_fast(others, add_special_tokens=False))
        return [next(rest).ids if ids is None else ids for ids in out]

    def _learn(self, units: list[str]) -> None:
        """Align new units and keep what is known of them, in order."""
        for at in range(0, len(units), 1024):
            some = units[at : at + 1024]
            of_a, of_b = self._ids_a(some), self.b.encode([u[1:] for u in some], num_threads=1)
            whole = [b"".join([self.bytes_a[k] for k in a]) == (data := u.encode()) == b"".join([self.bytes_b[k] for k in b]) for u, a, b in zip(some, of_a, of_b)]
            if not all(whole):  # those that are not given back have no tokens
                of_a, of_b = ([ids if w else [] for w, ids in zip(whole, of)] for of in (of_a, of_b))
            self._keep(of_a, of_b)
            self.used += sum(map(len, some)) + 200 * len(some)

    def _keep(self, of_a: list[list[int]], of_b: list[list[int]]) -> None:
        n, at = len(of_a), len(self.texts)
        a, b = (np.fromiter(chain.from_iterable(of), np.int64) for of in (of_a, of_b))
        units_a, units_b = (np.fromiter(map(len, of), np.int64, n) for of in (of_a, of_b))
        ends = Ends(self.size_a[a], self.size_b[b], units_a, units_b)
        links, link_a, link_b = ends.links()
        in_unit = np.bincount(np.repeat(np.arange(n), units_a), weights=links, minlength=n).astype(np.int64)
        if at + n > len(self.first):
            more = max(at + n, 2 * len(self.first))
            self.numbers, self.first = np.resize(self.numbers, (more, 4)), np.resize(self.first, more)
        if self.n_pairs + len(link_a) > len(self.pairs):
            self.pairs = np.resize(self.pairs, max(self.n_pairs + len(link_a), 2 * len(self.pairs)))
        self.numbers[at : at + n] = np.stack([units_a, units_b, np.bincount(ends.unit, minlength=n), in_unit], axis=1)
        self.first[at : at + n] = self.n_pairs + np.cumsum(in_unit) - in_unit
        self.pairs[self.n_pairs : self.n_pairs + len(link_a)] = a[link_a] * WIDE + b[link_b]
        self.n_pairs += len(link_a)
        names, tokens = self.names.interleaved(ends, a, b), np.cumsum(units_a + units_b)
        self.texts.extend(["".join(names[p:q])[:-1] for p, q in zip((tokens - units_a - units_b).tolist(), tokens.tolist())])
        self.used += 16 * len(names) + 4 * len(link_a)

    def documents(self, texts: list[str | None]) -> Iterator[Document]:
        """Each whole text aligned; new units of all of them are learnt together."""
        if self.used > self.most_bytes:
            self._forget()
        known = self.units_known
        found = [[np.array(list(map(known.__getitem__, self.units(part)))) for part in self.parts(text)] if text else [] for text in texts]
        self._learn(known.new)
        known.new = []
        return map(self._document, found)

    def _document(self, parts: list[np.ndarray]) -> Document:
        totals, digest, texts, pairs, numbers = np.zeros(4, np.int64), hashlib.sha256(), [], [], []
        for places in parts:
            place, times = np.unique(places, return_counts=True)
            known = self.numbers[place]
            if not known[:, 0].all():
                return NO_TOKENS
            totals += times @ known
            n = known[:, 3]
            pairs.append(self.pairs[np.arange(n.sum()) + np.repeat(self.first[place] - np.cumsum(n) + n, n)].tobytes())
            numbers.append(np.repeat(times.astype("<i4"), n).tobytes())
            own = self.texts
            texts.append(";".join([own[k] for k in places.tolist()]))
            digest.update((";" + texts[-1] if len(texts) > 1 else texts[-1]).encode())
        if not texts:
            return NO_TOKENS
        return Document(*totals.tolist(), ";".join(texts), digest.hexdigest(), b"".join(pairs), b"".join(numbers))


@functools.lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process."""
    return Aligner(path_a, path_b)


_COUNTS = "n_a long, n_b long, n_groups long, n_links long"


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text", with_groups: bool = False,
          block_size: int = BLOCK) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, groups_sha256, its block,
    its pairs and their numbers (``Document``); the groups themselves only ``with_groups``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, filled = load(path_a, path_b), 0
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = []
                values = part.column(1).to_pylist()
                for t, doc in zip(values, aligner.documents(values)):
                    rows.append((*doc, block) if with_groups else (*doc._replace(groups=None), block))
                    filled += len(t or "")
                    if filled > block_size:
                        block, filled = block + 1, 0
                kinds = (*[pa.int64()] * 4, pa.string(), pa.string(), pa.binary(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, type=k) for c, k in zip(zip(*rows), kinds))],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "pairs", "numbers", "block"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {_COUNTS}, groups string, groups_sha256 string, pairs binary, numbers binary, block long")
    return out if with_groups else out.drop("groups")


def _added(pairs: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, with the sum of its numbers."""
    own, at = np.unique(pairs, return_inverse=True)
    return own, np.bincount(at, weights=numbers, minlength=len(own)).astype(np.int64)


def _values(column: pa.Array) -> np.ndarray:
    """The int32 values of all rows of a binary column, one after the other, without a copy."""
    column = column.cast(pa.binary())  # also where Spark sends large offsets
    ends = np.frombuffer(column.buffers()[1], dtype="<i4")[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", dtype="<i4")[ends[0] // 4 : ends[-1] // 4]


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, pair, n) of the rows of each block as they come, added up some
    rows at a time; a block that two tasks read gives two rows a pair, which
    the sums over blocks add."""
    load.cache_clear()  # a worker that aligned before needs its words no more
    current, pairs, numbers = None, np.empty(0, "<i4"), np.empty(0, np.int64)

    def close() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), current)), pa.array(pairs), pa.array(numbers)], names=["block", "pair", "n"])

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cuts = np.union1d(np.flatnonzero(np.diff(blocks)) + 1, np.arange(0, len(blocks) + 1, 256))
        cuts = np.union1d(cuts, [len(blocks)])
        for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if blocks[first] != current:
                if len(pairs):
                    yield close()
                current, pairs, numbers = int(blocks[first]), pairs[:0], numbers[:0]
            part = batch.slice(first, last - first)
            pairs, numbers = _added(np.concatenate([pairs, _values(part.column(1))]), np.concatenate([numbers, _values(part.column(2))]))
    if len(pairs):
        yield close()


def pair_counts(sums: DataFrame) -> DataFrame:
    """Corpus-wide: pair, a, b, n (links) and best (no pair of its B id has
    more).  The maxima are one row per B id, fewer than ``WIDE``."""
    counts = sums.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % WIDE)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "b").select("pair", F.floor(F.col("pair") / WIDE).cast("int").alias("a"), "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _score_block(key: tuple, docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    load.cache_clear()  # a worker that aligned before needs its words no more
    known = known.sort_values("pair")
    pairs, counts, best = known["pair"].to_numpy(), known["n"].to_numpy(), known["best"].to_numpy()
    n_best, sums = [], []
    for own, numbers in zip(docs["pairs"], docs["numbers"]):
        at, times = np.searchsorted(pairs, np.frombuffer(own, "<i4")), np.frombuffer(numbers, "<i4").astype(np.int64)
        n_best.append(int(times[best[at]].sum()) if len(at) else 0)
        sums.append(int((times * counts[at]).sum()) if len(at) else 0)
    return docs.drop(columns=["pairs", "numbers", "block"]).assign(n_best=n_best, count_sum=sums)


def score(aligned: DataFrame) -> DataFrame:
    """Alignment scores per document: n_best (links whose pair is the most
    frequent of its B id) and count_sum (corpus-wide counts over its links).
    ``aligned`` is read twice, so pass a written table."""
    sums = written(aligned.select("block", "pairs", "numbers").mapInArrow(_block_sums, "block long, pair int, n long"), "align-sums")
    counts = written(pair_counts(sums).select("pair", "n", "best"), "align-counts")
    known = lane_lookup(sums.select("block", "pair"), counts, ["pair"], ["block"])
    rows = aligned.withColumn("id", F.col("id").cast("string"))  # pandas would round a long beside nulls
    scored = rows.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(
        _score_block, f"id string, {_COUNTS}, groups_sha256 string, n_best long, count_sum long")
    return scored.withColumn("id", F.col("id").cast(aligned.schema["id"].dataType))
