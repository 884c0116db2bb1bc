"""Merkle manifest of a dataset: cogrouped subtree exchange.

Every row is a leaf.  The leaves of a group (a language) ascend by id; every
``RUN`` consecutive nodes become the digest of their concatenated hex digests
until one node is left, the group's subroot; the subroots, ordered by group,
make the root likewise.  ``prove`` gives each row its proof and checks the
rows as they are presented (changed ones fail).

1. leaf digests are columns; texts are read once and never shuffled;
2. a row's place in its group is a skew-safe running sum, so a group with a
   third of all rows spreads over every task;
3. a superblock is ``RUN ** LOCAL`` leaves.  Superblocks are reduced to one
   node each, the few nodes above them level by level in Spark;
4. the runs on the way from a superblock to the root (the outer nodes that its
   proofs need) go down to the superblock, and leaves and outer nodes are
   cogrouped by superblock: one function reduces the leaves again, joins the
   local and outer siblings to proofs and folds the presented leaves.

A superblock is bounded, whatever the size of the group; the outer nodes of
one are at most ``RUN`` a level.  The loops run on the driver over levels (the
logarithm of the rows), which learns only the largest place of each tree.

Defined results: null fields count as ``-``; a null group is a group of its
own, first in order; null ids come first and are presented unchanged where
the change depends on the id; rows with one id are ordered by leaf digest
(equal rows are interchangeable); no rows give no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidpulse.llm.common import written
from vidpulse.operators.prefix import running_sum

#: Consecutive nodes that become one.
RUN = 8
#: Levels that one superblock reduces by itself (8 ** 4 = 4096 leaves).
LOCAL = 4

_TREE = ["named", "grp"]  # a group that may be null, as two columns that are not
_PROOF = "id string, grp string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 (binary) of the fields: ``-`` for null, else UTF-8 byte count, colon, value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _hash(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _levels(digests: list[str], block: int, local: int) -> list[list[str]]:
    """Node digests of a superblock, level by level.  Only a tree's first
    superblock can be a whole tree, which ends at its one node; all others
    have ``local`` levels above the leaves."""
    out = [digests]
    while len(out[-1]) > 1 or (block > 0 and len(out) <= local):
        below = out[-1]
        out.append([_hash(below[at : at + RUN]) for at in range(0, len(below), RUN)])
    return out


def placed_leaves(docs: DataFrame, fields: Sequence[str], id_col: str, group_col: str, presented: dict[str, Column] | None = None, local: int = LOCAL) -> DataFrame:
    """Per row: id, group, leaf, seen (the leaf as presented), its place in
    the group and its superblock.  Written once; texts stay behind."""
    fields = list(fields)
    seen = {**{c: F.col(c) for c in fields}, **(presented or {})}
    leaves = written(docs.select(
        F.col(id_col).alias("id"), F.col(group_col).isNotNull().alias("named"), F.coalesce(F.col(group_col).cast("string"), F.lit("")).alias("grp"),
        leaf_digest(*[F.col(c) for c in fields]).alias("leaf"), leaf_digest(*[seen[c] for c in fields]).alias("seen")), "merkle-leaves")
    ranked = running_sum(leaves.withColumn("row", F.monotonically_increasing_id()), ["id", "leaf", "row"], _TREE, out="place")
    place = F.col("place") - 1
    return written(ranked.select("id", *_TREE, "leaf", "seen", place.alias("place"), F.floor(place / RUN**local).alias("block")), "merkle-places")


def superblock_nodes(leaves: DataFrame, local: int = LOCAL) -> DataFrame:
    """One node per superblock: (tree, place, digest)."""
    def reduce(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        top = _levels([d.hex() for d in part["leaf"]], key[2], local)[-1][0]
        return pd.DataFrame({"named": [key[0]], "grp": [key[1]], "place": [key[2]], "digest": [top]})

    return leaves.select(*_TREE, "block", "place", "leaf").groupBy(*_TREE, "block").applyInPandas(
        reduce, "named boolean, grp string, place long, digest string")


def _runs(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Nodes of one level as runs of at most ``RUN``: (tree, place of the
    parent, digests in order, whether the run is a tree's one last node)."""
    runs = nodes.groupBy(*keys, F.floor(F.col("place") / RUN).alias("parent")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda s: s["digest"]).alias("run"))
    return runs.withColumn("last", (F.col("parent") == 0) & (F.size("run") == 1))


def grow(nodes: DataFrame, keys: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Levels above ``nodes`` (tree, place, digest) of every tree: the root
    digest per tree, and per node its ``path``, the runs on its way up with
    its own slot in each.  ``nodes`` is read twice, so pass a written table."""
    keys = list(keys)
    most = nodes.agg(F.max("place")).first()[0] or 0
    levels = []
    while most > 0:
        runs = written(_runs(nodes, keys), f"{name}-runs")
        levels.append(runs)
        top = F.when(F.col("last"), F.col("run")[0]).otherwise(F.sha2(F.array_join("run", ""), 256))
        nodes = runs.select(*keys, F.col("parent").alias("place"), top.alias("digest"))
        most = math.ceil((most + 1) / RUN) - 1
    roots = nodes.select(*keys, F.col("digest").alias("root"))
    step = "struct<slot:int,run:array<string>>"
    paths = nodes.select(*keys, "place", F.array().cast(f"array<{step}>").alias("path"))
    for runs in reversed(levels):
        above = runs.join(paths.withColumnRenamed("place", "parent"), [*keys, "parent"])
        down = above.select(*keys, "parent", "run", "last", "path", F.posexplode("run").alias("slot", "_"))
        own = F.array(F.struct("slot", "run").cast(step))
        paths = written(down.select(
            *keys, (F.col("parent") * RUN + F.col("slot")).alias("place"),
            F.when(F.col("last"), F.col("path")).otherwise(F.concat(own, "path")).alias("path")), f"{name}-paths")
    return roots, paths


def outer_nodes(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From superblock nodes (written): per group its subroot and root, and
    per superblock the runs between it and the root, one row a level
    (``top`` false below the subroot, true above)."""
    roots, paths = grow(nodes, _TREE, "merkle-group")
    order = running_sum(roots, _TREE, out="place")
    subroots = written(order.select(*_TREE, F.col("root").alias("digest"), (F.col("place") - 1).alias("place"), F.lit(0).alias("tree")), "merkle-subroots")
    top_roots, top_paths = grow(subroots, ["tree"], "merkle-top")
    groups = subroots.join(top_roots, "tree").join(top_paths, ["tree", "place"]).select(
        *_TREE, F.col("digest").alias("subroot"), "root", F.col("path").alias("top_path"))
    rows = lambda path, top: F.transform(path, lambda s, i: F.struct(F.lit(top).alias("top"), i.alias("level"), s["slot"].alias("slot"), s["run"].alias("run")))
    joined = paths.join(groups, _TREE)
    outer = joined.select(*_TREE, F.col("place").alias("block"), F.explode_outer(F.concat(rows(F.col("path"), False), rows(F.col("top_path"), True))).alias("o"))
    return groups.drop("top_path"), outer.select(*_TREE, "block", "o.*")


def _prove_block(key: tuple, leaves: pd.DataFrame, outer: pd.DataFrame, local: int) -> pd.DataFrame:
    """Local reduction, proof joining and folding of one superblock."""
    leaves = leaves.sort_values("place")
    nodes = _levels([d.hex() for d in leaves["leaf"]], key[2], local)
    outer = outer[outer["level"].notna()].sort_values(["top", "level"])
    above = [(bool(t), list(r[: int(s)]), list(r[int(s) + 1 :])) for t, s, r in zip(outer["top"], outer["slot"], outer["run"])]
    outer_siblings = "".join(d for _, before, after in above for d in (*before, *after))

    def fold(digest: str, way: list[tuple[list[str], list[str]]]) -> tuple[str, str]:
        for before, after in way:
            digest = _hash([*before, digest, *after])
        subroot = digest
        for top, before, after in above:
            digest = _hash([*before, digest, *after])
            subroot = subroot if top else digest
        return subroot, digest

    out: list[tuple] = []
    for at, (row_id, leaf, seen) in enumerate(zip(leaves["id"], nodes[0], leaves["seen"])):
        way, k = [], at
        for level in nodes[:-1]:
            first = k - k % RUN
            way.append((level[first:k], level[k + 1 : first + RUN]))
            k //= RUN
        proof = "".join(d for before, after in way for d in (*before, *after)) + outer_siblings
        subroot, root = fold(leaf, way)
        folded = fold(seen.hex(), way)[1]
        out.append((row_id, key[1] if key[0] else None, leaf, subroot, root, hashlib.sha256(proof.encode()).hexdigest(), folded, folded == root))
    return pd.DataFrame(out, columns=["id", "grp", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def prove(docs: DataFrame, fields: Sequence[str], id_col: str = "doc_id", group_col: str = "lang", presented: dict[str, Column] | None = None, local: int = LOCAL) -> DataFrame:
    """Per row: id, grp, leaf, subroot, root, proof_sha256 (all of the rows as
    they are), folded_root (from the leaf as presented) and verified.

    ``presented`` gives fields as they are shown to the verifier, ``local``
    the levels of a superblock.
    """
    leaves = placed_leaves(docs, fields, id_col, group_col, presented, local)
    nodes = written(superblock_nodes(leaves, local), "merkle-blocks")
    _, outer = outer_nodes(nodes)
    keys = [*_TREE, "block"]
    named = leaves.withColumn("id", F.col("id").cast("string"))  # pandas would round a long beside nulls
    proofs = named.groupBy(*keys).cogroup(outer.groupBy(*keys)).applyInPandas(
        lambda key, own, above: _prove_block(key, own, above, local), _PROOF)
    return proofs.withColumn("id", F.col("id").cast(leaves.schema["id"].dataType))


def manifest(docs: DataFrame, fields: Sequence[str], id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """What is published of a dataset: per group its leaves, subroot and the root."""
    leaves = placed_leaves(docs, fields, id_col, group_col)
    groups, _ = outer_nodes(written(superblock_nodes(leaves), "merkle-blocks"))
    sizes = leaves.groupBy(*_TREE).agg(F.count(F.lit(1)).alias("n_leaves"))
    return sizes.join(groups, _TREE).select(F.when(F.col("named"), F.col("grp")).alias("grp"), "n_leaves", "subroot", "root")
