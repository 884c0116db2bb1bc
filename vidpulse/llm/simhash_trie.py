"""SimHash near-dedup: fingerprints, binary trie self-join, components.

1. Fingerprints of whole texts in Arrow batches (xxhash, numpy bit counts).
2. Distinct fingerprints enter a trie self-join.  At most ``max_bits`` bits
   may differ, so of ``max_bits + 1`` blocks one is equal: each fingerprint
   starts once per block, below the node that this block's bits name, and
   linked pairs meet under an equal node.  Under a node the binary trie of
   the other bits is traversed as *pairs of nodes*: differing bits add up
   along the path, a pair beyond the budget is pruned.  A trie node is a
   range of a sorted array, so all pairs of a level advance in numpy at once.
3. A node with more than ``MAX_NODE`` fingerprints is split again by blocks
   of its own remaining bits (exact by the same argument), until it is small.
4. Tasks unite the pairs they find and emit a star per group, not all pairs;
   alternating large and small stars over Spark joins unite the rest.

Defined results: null or blank text has fingerprint zero, linked like any
other; repeated rows and ids are counted per row; a null id never names a
component while another id is in it; no rows give no rows; further columns
are ignored, or passed through by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidpulse.llm.common import lane_lookup, scratch_path, written

SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: Fingerprints below one trie start node before it is split again.
MAX_NODE = 4096
#: Rows that a task traverses at once (whole nodes), and node pairs in flight.
BLOCK_ROWS, FRONTIER = 100_000, 400_000
_FOLD = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text, unsigned."""
    parts = (text or "").encode().translate(_FOLD).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > shingle:
        starts, ends = starts[: len(parts) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    total = np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), 65_536):
        digests = b"".join([xxhash.xxh64_digest(joined[a:b], SEED) for a, b in zip(starts[k : k + 65_536].tolist(), ends[k : k + 65_536].tolist())])
        total += np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big")


#: What tells rows apart: id, hash and size of the text.
TAG = ["id", "hash", "n_bytes"]


def _tags(id_col: str, text: str) -> list:
    whole = F.coalesce(F.col(text), F.lit(""))
    return [F.col(id_col).alias("id"), F.xxhash64(whole).alias("hash"), F.octet_length(whole).cast("long").alias("n_bytes")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, hash, n_bytes, fp) per row, ``fp`` as signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(3)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps)], names=[*TAG, "fp"])

    rows = docs.select(*_tags(id_col, text), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, hash long, n_bytes long, fp long")


class _Union:
    """Smallest index per group of united indexes."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (jump := self.label[self.label] != self.label).any():
                self.label[jump] = self.label[self.label[jump]]


def trie_links(node: np.ndarray, rest: np.ndarray, width: int, max_bits: int) -> np.ndarray:
    """Smallest linked index of each row; ``rest`` (``width`` bits) is sorted
    within equal ``node`` values, which stand together."""
    n, united = len(rest), _Union(len(rest))
    cuts = np.concatenate(([0], np.flatnonzero(node[1:] != node[:-1]) + 1, [n]))
    lo, hi = cuts[:-1], cuts[1:]
    many = hi - lo > 1
    start = np.stack([lo[many], hi[many], lo[many], hi[many], np.zeros(many.sum(), dtype=np.int64)])
    ones: dict[int, np.ndarray] = {}
    stack = [(width - 1, start[:, k : k + FRONTIER]) for k in range(0, start.shape[1], FRONTIER)]
    while stack:
        bit, pairs = stack.pop()
        a0, a1, b0, b1, d = pairs
        size_a, size_b = a1 - a0, b1 - b0
        leaf = (size_a * size_b <= 32) if bit >= 0 else np.ones(len(a0), dtype=bool)
        if leaf.any():
            la, sa, lb, sb = a0[leaf], size_a[leaf], b0[leaf], size_b[leaf]
            each = sa * sb
            ends = np.cumsum(each)
            for first, last in _spans(ends, 4 * FRONTIER):
                rep = np.repeat(np.arange(first, last), each[first:last])
                k = np.arange(len(rep)) - np.repeat(ends[first:last] - each[first:last] - (ends[first - 1] if first else 0), each[first:last])
                i, j = la[rep] + k // sb[rep], lb[rep] + k % sb[rep]
                near = (np.bitwise_count(rest[i] ^ rest[j]) <= max_bits) & (i != j)
                united.add(i[near], j[near])
        if leaf.all():
            continue
        a0, a1, b0, b1, d = pairs[:, ~leaf]
        if bit not in ones:
            ones[bit] = np.concatenate(([0], np.cumsum((rest >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        c = ones[bit]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        same = (a0 == b0) & (a1 == b1)
        child = np.concatenate([
            np.stack([a0, am, b0, bm, d]), np.stack([am, a1, bm, b1, d]), np.stack([a0, am, bm, b1, d + 1]),
            np.stack([am, a1, b0, bm, d + 1])[:, ~same]], axis=1)
        alive = (child[1] > child[0]) & (child[3] > child[2]) & (child[4] <= max_bits)
        alive &= ~((child[0] == child[2]) & (child[1] - child[0] == 1) & (child[3] - child[2] == 1))
        child = child[:, alive]
        stack += [(bit - 1, child[:, k : k + FRONTIER]) for k in range(0, child.shape[1], FRONTIER)]
    return united.label


def _spans(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Index spans whose sizes add up to about ``most``."""
    first = 0
    while first < len(ends):
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield first, last
        first = last


def _stars(entries: DataFrame, width: int, max_bits: int) -> DataFrame:
    """(u, v) fingerprints linked below an equal node, one star per group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def links(rows: pa.Table) -> pa.RecordBatch:
            fp = rows.column("fp").to_numpy()
            node = rows.column("node").combine_chunks().dictionary_encode()
            node = (node.combine_chunks() if isinstance(node, pa.ChunkedArray) else node).indices.to_numpy()
            label = trie_links(node, rows.column("rest").to_numpy().view(np.uint64), width, max_bits)
            moved = label != np.arange(len(label))
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[label[moved]])], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= BLOCK_ROWS:
                rows = pa.Table.from_batches(held)
                last = rows.column("node")[count - 1]
                # the last node may go on in the next batch
                whole = int(np.searchsorted(_starts_at(rows.column("node"), last), True))
                if whole:
                    yield links(rows.slice(0, whole))
                held = rows.slice(whole).combine_chunks().to_batches()
                count -= whole
        if count:
            yield links(pa.Table.from_batches(held))

    dealt = entries.repartition("node").sortWithinPartitions("node", "rest")
    return dealt.select("fp", "node", "rest").mapInArrow(run, "u long, v long")


def _starts_at(column: pa.ChunkedArray, value: pa.Scalar) -> np.ndarray:
    """False before the trailing run of ``value``, True within it (sorted column)."""
    import pyarrow.compute as pc

    return pc.equal(column, value).to_numpy()


def _split(entries: DataFrame, width: int, blocks: int) -> tuple[DataFrame, int]:
    """Each entry once per block of its ``rest``: the block's bits go to
    ``node``, the other bits stay.  Returns the widest rest as well."""
    cuts = [width * k // blocks for k in range(blocks + 1)]
    starts = []
    for k in range(blocks):
        low, size = width - cuts[k + 1], cuts[k + 1] - cuts[k]
        block = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << size) - 1).cast("long"))
        above = F.shiftrightunsigned("rest", low + size) if low + size < 64 else F.lit(0).cast("long")
        below = F.col("rest").bitwiseAND(F.lit((1 << low) - 1).cast("long"))
        starts.append(F.struct(F.concat_ws("/", "node", F.lit(str(k)), F.hex(block)).alias("node"),
                               F.shiftleft(above, low).bitwiseOR(below).alias("rest")))
    size = max(width - (cuts[k + 1] - cuts[k]) for k in range(blocks))
    out = entries.select("fp", F.explode(F.array(*starts)).alias("s")).select("fp", "s.node", "s.rest")
    return out, size


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v) over distinct fingerprints ``fp``: connects exactly the
    fingerprints that a chain of at most ``max_bits`` differing bits joins."""
    spark, parts = prints.sparkSession, []
    entries, width = prints.select("fp", F.lit("").alias("node"), F.col("fp").alias("rest")), 64
    while True:
        entries, width = _split(entries, width, max_bits + 1)
        entries = written(entries, "trie-entries")
        large = written(entries.groupBy("node").count().where(F.col("count") > MAX_NODE).select("node"), "trie-large")
        if width <= 2 * (max_bits + 1) or large.isEmpty():
            parts.append(_stars(entries, width, max_bits))
            break
        parts.append(_stars(entries.join(large, "node", "left_anti"), width, max_bits))
        entries = entries.join(large, "node", "left_semi")
    path = scratch_path(spark, "trie-links")
    for part in parts:
        part.write.mode("append").parquet(path)
    return spark.read.schema("u long, v long").parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) per fingerprint with a link: alternating large and small
    stars until the edge set stays the same."""
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    before = mark(edges)
    while before[0]:
        both = written(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "cc-both")
        found = lane_lookup(both, smallest(both), ["u"], ["v"])
        # large star: each larger neighbour points to the smallest one around
        large = found.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = written(large.where("u != v").distinct(), "cc-large")
        # small star: the node and its smaller neighbours point to the smallest
        found = lane_lookup(large, smallest(large), ["u"], ["v"])
        small = found.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = written(small.where("u != v").distinct(), "cc-edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.groupBy(F.col("u").alias("fp")).agg(F.min("v").alias("root"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, hash, n_bytes, fp, root, component_id) per row of ``docs``;
    ``hash`` and ``n_bytes`` are of the text, ``root`` names the component."""
    rows = written(fingerprints(docs, id_col, text, shingle), "fingerprints")
    prints = written(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "prints")
    roots = components(links(prints, max_bits))
    named = written(prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = lane_lookup(named, ids, ["root"], ["fp"]).select("fp", "root", "component_id")
    return lane_lookup(rows, classes, ["fp"], ["id", "hash"])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row left of each component, all columns: the one
    with the smallest id (of repeated ids, the smallest text hash)."""
    tag = F.struct(F.col("id").isNull().alias("none"), "id", "hash", "n_bytes")
    kept = near_groups(docs, id_col, text, shingle, max_bits).groupBy("root").agg(F.min(tag).alias("keep")).select(*[F.col(f"keep.{c}").alias(f"k_{c}") for c in TAG])
    wide = docs.select(F.struct("*").alias("row"), *_tags(id_col, text))
    once = wide.withColumn("nth", F.row_number().over(Window.partitionBy(*TAG).orderBy("hash"))).where("nth = 1")
    match = F.lit(True)
    for c in TAG:
        match = match & F.col(c).eqNullSafe(F.col(f"k_{c}"))
    return once.join(kept, match, "left_semi").select("row.*")
