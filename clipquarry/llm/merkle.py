"""Merkle manifest of a dataset, its nodes stored in the van Emde Boas layout.

Every row is a leaf. The leaves of a source ascend by id, and every 16 consecutive nodes (the last run may be shorter)
become the hash of their digests, until one is left; the subroots of the sources become the root the same way.

A tree is cut into aligned blocks of ``BLOCK_LEVELS`` levels of nodes, at most 16 ** 3 leaves. The digests of a block lie in
one binary value in the van Emde Boas order: its levels are split at half their height, the top subtree comes first, the
bottom subtrees follow from left to right, and each of them is laid out the same way, so that at every scale of a
cache a subtree lies together. ``place`` finds a node by arithmetic alone, also in trees that are not full; building
and the retrieval of siblings both go through it. The roots of the blocks are the leaves of the next layer.

Texts are read once, by the hashes of the leaves. Leaves are numbered by one range-partitioned sort, so that a source
with most of the rows is spread over partitions, and a block is bounded whatever its source."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipquarry.llm.common import store
from clipquarry.operators.ordering import number_rows

ARITY = 16
BLOCK_LEVELS = 4
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# -- the layout of one block ------------------------------------------------------------------------------------------


def width(n, level: int):
    """Nodes of a level above ``n`` leaves."""
    return -(-n // ARITY**level)


def size(n, levels: int):
    return sum(width(n, level) for level in range(levels))


def place(level: int, index: np.ndarray, n, levels: int) -> np.ndarray:
    """Where the nodes ``index`` of a level (0: leaves) lie in a tree of ``levels`` levels over ``n`` leaves."""
    if levels == 1:
        return np.zeros_like(index)
    low = levels // 2  # levels of the bottom subtrees
    top = width(n, low)
    if level >= low:
        return place(level - low, index, top, levels - low)
    across, full = ARITY ** (low - 1 - level), ARITY ** (low - 1)
    tree = index // across
    before = size(top, levels - low) + tree * size(full, low)
    return before + place(level, index - tree * across, np.minimum(full, n - tree * full), low)


def height(n: int) -> int:
    """Levels of a tree over ``n`` leaves that ends in one node."""
    levels = 1
    while width(n, levels - 1) > 1:
        levels += 1
    return levels


def level_of(nodes: np.ndarray, level: int, n: int, levels: int) -> str:
    """The digests of one level as hex text, from left to right."""
    return nodes[place(level, np.arange(width(n, level)), n, levels)].tobytes().hex()


def build_block(leaves: np.ndarray, levels: int) -> np.ndarray:
    """The digests of a block (rows of 32 bytes) in the layout, from those of its leaves."""
    n = len(leaves)
    nodes = np.empty((size(n, levels), DIGEST), np.uint8)
    nodes[place(0, np.arange(n), n, levels)] = leaves
    for level in range(1, levels):
        below, step = level_of(nodes, level - 1, n, levels).encode(), ARITY * DIGEST * 2
        made = b"".join(hashlib.sha256(below[i:i + step]).digest() for i in range(0, len(below), step))
        at = place(level, np.arange(width(n, level)), n, levels)
        nodes[at] = np.frombuffer(made, np.uint8).reshape(-1, DIGEST)
    return nodes


def root_of(nodes: np.ndarray, n: int, levels: int) -> bytes:
    return nodes[place(levels - 1, np.zeros(1, np.int64), n, levels)[0]].tobytes()


def sibling_paths(nodes: np.ndarray, n: int, levels: int) -> Iterator[list[tuple[str, str]]]:
    """Of each leaf, level by level: the siblings to its left and to its right, as hex text."""
    rows, one, run = [level_of(nodes, k, n, levels) for k in range(levels - 1)], DIGEST * 2, DIGEST * 2 * ARITY
    for i in range(n):
        path = []
        for text in rows:
            at = i * one
            first = at - at % run
            path.append((text[first:at], text[at + one:first + run]))
            i //= ARITY
        yield path


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


# -- the manifest -----------------------------------------------------------------------------------------------------


@dataclass
class Manifest:
    """``layers`` of the trees of the sources and ``top``, those of the tree of subroots, leaves first. A row is a block:
    ``tree``, ``block``, ``levels``, ``n`` (its leaves), ``nodes`` (their digests in the layout), ``root``. The first layer also
    has ``doc_ids`` and ``candidates``, what is to be verified for each leaf."""

    layers: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame  # index, digest, below: the leaves of the top and whose roots they are
    block_levels: int

    def root(self) -> str | None:
        row = self.top[-1].select(F.lower(F.hex("root"))).first()
        return row[0] if row else None


def leaf_hash(fields: list[Column]) -> Column:
    """SHA-256 of the values, each as its UTF-8 byte count, a colon and itself, or a dash where null."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def leaves(
    docs: DataFrame,
    *,
    fields: tuple[str, ...] = FIELDS,
    doc_id: str = "doc_id",
    source: str = "source",
    changed: Callable[[dict[str, Column]], dict[str, Column]] | None = None,
    when: Column | None = None,
) -> DataFrame:
    """``tree`` (the source's key), ``source``, ``doc_id``, ``leaf`` and ``candidate``: the leaf of the row as it is to be
    verified, which differs from ``leaf`` only in rows where ``when`` holds and ``changed`` gives a field another value."""
    columns = {f: F.col(f"`{f}`") for f in fields}
    leaf, candidate = leaf_hash(list(columns.values())), F.lit(None).cast("binary")
    if changed is not None:
        other = leaf_hash(list((columns | changed(columns)).values()))
        candidate = F.when(F.lit(True) if when is None else when, other)
    key = F.col(f"`{source}`").cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit(":"), key), F.lit("-")).alias("tree"),
        key.alias("source"),
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        leaf.alias("leaf"),
        candidate.alias("candidate"),
    )
    return rows.withColumn("candidate", F.coalesce("candidate", "leaf"))


_BLOCK = "tree string, block long, levels int, n int, nodes binary, root binary"


def layer(rows: DataFrame, name: str, levels: int, documents: bool = False) -> DataFrame:
    """The blocks of ``tree``, ``index``, ``digest`` (and, of leaves, ``doc_id`` and ``candidate``), stored. The first block of a
    tree that is not full is the whole tree and ends where one node is left; all others have all their levels."""
    most = ARITY ** (levels - 1)
    carried = ["doc_id", "candidate"] if documents else []
    ordered = (
        rows.select("tree", F.floor(F.col("index") / most).cast("long").alias("block"), "index", "digest", *carried)
        .repartition("tree", "block")
        .sortWithinPartitions("tree", "block", "index")
    )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def close() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            n = whole.num_rows
            digests = np.frombuffer(b"".join(whole["digest"].to_pylist()), np.uint8).reshape(n, DIGEST)
            own = min(levels, height(n)) if key[1] == 0 and n < most else levels
            nodes = build_block(digests, own)
            made = [
                pa.array([key[0]], pa.string()),
                pa.array([key[1]], pa.int64()),
                pa.array([own], pa.int32()),
                pa.array([n], pa.int32()),
                pa.array([nodes.tobytes()], pa.binary()),
                pa.array([root_of(nodes, n, own)], pa.binary()),
            ]
            names = ["tree", "block", "levels", "n", "nodes", "root"]
            if documents:
                made += [pa.array([whole["doc_id"].to_pylist()], pa.list_(pa.int64()))]
                made += [pa.array([b"".join(whole["candidate"].to_pylist())], pa.binary())]
                names += ["doc_ids", "candidates"]
            return pa.RecordBatch.from_arrays(made, names)

        for batch in batches:
            tree, block = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            first = 0
            for i in range(len(tree)):
                if (tree[i], block[i]) != key:
                    if i > first:
                        held.append(batch.slice(first, i - first))
                    if held:
                        yield close()
                        held.clear()
                    first, key = i, (tree[i], block[i])
            if len(tree) > first:
                held.append(batch.slice(first))
        if held:
            yield close()

    return store(ordered.mapInArrow(blocks, _BLOCK + (", doc_ids array<long>, candidates binary" if documents else "")), name)


def layers_of(rows: DataFrame, name: str, levels: int, documents: bool = False) -> list[DataFrame]:
    """Layer upon layer until every tree is one block; a tree that has ended passes its root on."""
    made = [layer(rows, f"{name}0", levels, documents)]
    while (made[-1].agg(F.max("block")).first()[0] or 0) > 0:
        roots = made[-1].select("tree", F.col("block").alias("index"), F.col("root").alias("digest"))
        made.append(layer(roots, f"{name}{len(made)}", levels))
    return made


def build(rows: DataFrame, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of :func:`leaves`. Rows of one source and id are in the order of their leaves, null ids first. The subroots
    of the sources ascend by the sources' UTF-8 bytes, the null source first. An empty table has no blocks."""
    kept = store(rows, "leaves")  # narrow: the texts are not read again to find the ranges
    numbered = number_rows(kept, ["doc_id", "leaf"], out="index", within=["tree"])
    numbered = numbered.select("tree", "index", F.col("leaf").alias("digest"), "doc_id", "candidate")
    inner = layers_of(numbered, "blocks", block_levels, documents=True)
    # a dash sorts before a colon, and the source's own bytes follow the colon
    subroots = number_rows(inner[-1].select("tree", F.col("root").alias("digest")), ["tree"], out="index")
    named = store(subroots.select("index", "digest", F.col("tree").alias("below")), "subroots")
    top = layers_of(named.select(F.lit("").alias("tree"), "index", "digest"), "top", block_levels)
    return Manifest(inner, top, named, block_levels)


_PATH = "path array<struct<left:string,right:string>>"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _opened(row: dict) -> Iterator[list[tuple[str, str]]]:
    """The paths of a block's leaves up to the root, its own path behind those inside it."""
    nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)
    above = [(p["left"], p["right"]) for p in row["path"]]
    for own in sibling_paths(nodes, row["n"], row["levels"]):
        yield own + above


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def descend(blocks: DataFrame, paths: DataFrame, block_levels: int) -> DataFrame:
    """From the ``path`` of every block (``tree``, ``block``) those of its leaves, which are blocks of the layer below."""
    most = ARITY ** (block_levels - 1)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = [[{"left": a, "right": b} for a, b in path] for path in _opened(row)]
            first = row["block"] * most
            made = [
                pa.array([row["tree"]] * row["n"], pa.string()),
                pa.array(range(first, first + row["n"]), pa.int64()),
                pa.array(found, _PATH_TYPE),
            ]
            yield pa.RecordBatch.from_arrays(made, ["tree", "block", "path"])

    joined = blocks.select("tree", "block", "levels", "n", "nodes").join(paths, ["tree", "block"])
    return joined.mapInArrow(lead, f"tree string, block long, {_PATH}")


def prove(manifest: Manifest) -> DataFrame:
    """One row per document: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the siblings up to the root),
    ``folded_root`` (what the row's candidate and these siblings give) and ``verified`` (whether that is the root). Digests
    are lower-case hex. Paths are handed down layer by layer; each join has one row per block."""
    root, levels = manifest.root(), manifest.block_levels
    start = F.array().cast("array<struct<left:string,right:string>>")
    paths = manifest.top[-1].select("tree", "block", start.alias("path"))
    for blocks in reversed(manifest.top):
        paths = descend(blocks, paths, levels)
    named = manifest.subroots.withColumnRenamed("index", "block")
    paths = paths.select("block", "path").join(named, "block").select(
        F.col("below").alias("tree"), F.lit(0).cast("long").alias("block"), "path"
    )
    for blocks in reversed(manifest.layers[1:]):
        paths = descend(blocks, paths, levels)
    documents, subroots = manifest.layers[0], manifest.subroots.select(F.col("below").alias("tree"), F.col("digest").alias("subroot"))
    joined = documents.join(paths, ["tree", "block"]).join(subroots, "tree")
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            nodes, n = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST), row["n"]
            own, other, one = level_of(nodes, 0, n, row["levels"]), row["candidates"].hex(), 2 * DIGEST
            proofs, folded = [], []
            for i, path in enumerate(_opened(row)):
                proofs.append(hashlib.sha256("".join(a + b for a, b in path).encode()).hexdigest())
                folded.append(fold(other[i * one:(i + 1) * one], path))
            made = [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array([own[i * one:(i + 1) * one] for i in range(n)], pa.string()),
                pa.array([row["subroot"].hex()] * n, pa.string()),
                pa.array([root] * n, pa.string()),
                pa.array(proofs, pa.string()),
                pa.array(folded, pa.string()),
                pa.array([f == root for f in folded], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(made, names)

    text = ", ".join(f"{c} string" for c in names[1:-1])
    return joined.mapInArrow(verify, f"doc_id long, {text}, verified boolean")
