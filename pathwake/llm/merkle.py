"""Merkle manifest of a table: one digest for all rows, and a proof for each row.

Rows are leaves of one tree a source; the roots of the sources are leaves of one tree above.
Every three consecutive nodes become the digest of their digests until one node remains.

A tree is cut into aligned blocks of ``BLOCK_LEVELS`` levels. The roots of the blocks are the
leaves of the next layer of blocks, and so on, so that a source of any size is many small
blocks. A block is one row that keeps its digests in a van Emde Boas layout: the levels are
split at half height, the tree of the upper half comes first, then the trees of the lower half,
each laid out the same way. Addresses follow from level and index alone; they serve both the
construction and the reading of siblings. Only the last subtree of a split can be partial and
it comes last, so a partial block has no gaps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.operators.ordering import with_position
from pathwake.operators.skew import null_safe_join
from pathwake.runtime import stored

FAN = 3  # fixed by the contract
BLOCK_LEVELS = 6  # levels of hashing in a block: up to 729 leaves
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_SIZE = 32


def row_digest(columns: list[Column]) -> Column:
    """SHA-256 of the columns' texts: ``-`` for null, else byte count, colon and value."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


@lru_cache(maxsize=256)
def addresses(leaves: int, levels: int) -> tuple[np.ndarray, ...]:
    """Addresses of the nodes of each level, leaves first, in a tree of ``levels`` node levels."""
    if levels == 1:
        return (np.zeros(1, dtype=np.int64),)
    lower = levels // 2
    width = FAN ** (lower - 1)
    upper = addresses(-(-leaves // FAN**lower), levels - lower)
    whole, rest = divmod(leaves, width)
    first = sum(len(level) for level in upper)
    shape = addresses(width, lower)
    size = sum(len(level) for level in shape)
    found = []
    for level in range(lower):
        nodes = (first + size * np.arange(whole)[:, None] + shape[level][None, :]).ravel()
        if rest:
            nodes = np.concatenate([nodes, first + size * whole + addresses(rest, lower)[level]])
        found.append(nodes)
    return (*found, *upper)


def node_levels(leaves: int, only: bool, block_levels: int) -> int:
    """Node levels of a block: as many as its leaves need if it is a whole tree, else all."""
    if not only:
        return block_levels + 1
    levels = 1
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def parent(run: bytes) -> bytes:
    """Digest of a run of raw digests, joined as lowercase hex."""
    return hashlib.sha256(run.hex().encode()).digest()


def build_block(leaves: list[bytes], levels: int) -> bytes:
    """All digests of a block in its layout; the root comes first."""
    places = addresses(len(leaves), levels)
    out = bytearray(_SIZE * sum(len(level) for level in places))
    nodes = leaves
    for level in range(levels):
        for at, node in zip(places[level].tolist(), nodes, strict=True):
            out[_SIZE * at:_SIZE * at + _SIZE] = node
        if level + 1 < levels:
            nodes = [parent(b"".join(nodes[i:i + FAN])) for i in range(0, len(nodes), FAN)]
    return bytes(out)


def block_path(block: bytes, leaves: int, levels: int, leaf: int) -> list[tuple[bytes, int]]:
    """For each level from a leaf to the root of its block: the run of the node and its slot there."""
    places = addresses(leaves, levels)
    path = []
    for level in range(levels - 1):
        first = leaf - leaf % FAN
        run = b"".join(block[_SIZE * at:_SIZE * at + _SIZE] for at in places[level][first:first + FAN].tolist())
        path.append((run, leaf % FAN))
        leaf //= FAN
    return path


def fold(leaf: bytes, path: list[tuple[bytes, int]]) -> bytes:
    """Root that follows from a leaf and the siblings of a path."""
    for run, slot in path:
        leaf = parent(run[:_SIZE * slot] + leaf + run[_SIZE * (slot + 1):])
    return leaf


def siblings(path: list[tuple[bytes, int]]) -> str:
    """The runs of a path without the node itself, as hex, in order."""
    return "".join((run[:_SIZE * slot] + run[_SIZE * (slot + 1):]).hex() for run, slot in path)


_BLOCK = "n int, levels int, digests binary"
_PATH = "array<struct<run: binary, slot: int>>"


def _layer(nodes: DataFrame, keys: list[str], block_levels: int) -> DataFrame:
    """Blocks of ``nodes(keys, position, digest, payload)``; one row a block, bounded in size."""
    width = FAN**block_levels
    members = F.array_sort(F.collect_list(F.struct("position", "digest", "payload"))).alias("m")
    grouped = nodes.groupBy(*keys, F.expr(f"position div {width}").alias("block")).agg(members)
    rows = grouped.select(*keys, "block", F.col("m.digest").alias("leaf"), F.col("m.payload").alias("payload"))
    schema = rows.schema

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for block, leaves in zip(batch.column("block").to_pylist(), batch.column("leaf").to_pylist(), strict=True):
                levels = node_levels(len(leaves), block == 0 and len(leaves) < width, block_levels)
                found.append((len(leaves), levels, build_block(leaves, levels)))
            kept = [i for i, f in enumerate(schema) if f.name != "leaf"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept]
                + [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.binary())],
                names=[schema[i].name for i in kept] + ["n", "levels", "digests"],
            )

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != "leaf"]
    return rows.mapInArrow(build, ", ".join(kept) + ", " + _BLOCK)


@dataclass(frozen=True)
class Tree:
    """Layers of blocks, the lowest first; the last has one block a tree, whose root is the tree's."""

    keys: list[str]
    layers: list[DataFrame]

    def roots(self) -> DataFrame:
        return self.layers[-1].select(*self.keys, F.substring("digests", 1, _SIZE).alias("digest"))


def build_tree(nodes: DataFrame, keys: list[str], block_levels: int = BLOCK_LEVELS) -> Tree:
    """Trees over ``nodes(keys, position, digest, payload)``, positions from 0 in each tree.

    Each layer is written once; only whether a tree has more than one block reaches the driver.
    """
    layers = [stored(_layer(nodes, keys, block_levels), "merkle")]
    while layers[-1].filter("block > 0").limit(1).count():
        roots = layers[-1].select(
            *keys, F.col("block").alias("position"), F.substring("digests", 1, _SIZE).alias("digest"), F.lit(None).cast("int").alias("payload")
        )
        layers.append(stored(_layer(roots, keys, block_levels), "merkle"))
    return Tree(keys, layers)


def _members(blocks: DataFrame, keys: list[str], block_levels: int) -> DataFrame:
    """``(keys, position, path, subroot, root)`` of each leaf of ``blocks(…, above, subroot, root)``."""
    width = FAN**block_levels

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("block", "n", "levels", "digests", "above")}
            rows, positions, found = [], [], []
            for i in range(batch.num_rows):
                n, levels, digests = columns["n"][i], columns["levels"][i], columns["digests"][i]
                for leaf in range(n):
                    rows.append(i)
                    positions.append(columns["block"][i] * width + leaf)
                    inside = [{"run": run, "slot": slot} for run, slot in block_path(digests, n, levels, leaf)]
                    found.append(inside + columns["above"][i])
            kind = pa.list_(pa.struct([("run", pa.binary()), ("slot", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).take(pa.array(rows, pa.int64())) for k in (*keys, "subroot", "root")]
                + [pa.array(positions, pa.int64()), pa.array(found, kind)],
                names=[*keys, "subroot", "root", "position", "path"],
            )

    kinds = dict(blocks.select(*keys).dtypes)
    rows = blocks.select(*keys, "block", "n", "levels", "digests", "above", "subroot", "root")
    return rows.mapInArrow(paths, "".join(f"`{k}` {kinds[k]}, " for k in keys) + f"subroot binary, root binary, position bigint, path {_PATH}")


def with_paths(tree: Tree, above: DataFrame, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """The lowest blocks of ``tree`` with ``above``, the path from the block's root to the very root.

    ``above`` gives ``(keys, position, path, subroot, root)`` of each tree's root, position 0.
    """
    for depth in range(len(tree.layers) - 1, -1, -1):
        at = above.select(*tree.keys, F.col("position").alias("block"), F.col("path").alias("above"), "subroot", "root")
        blocks = null_safe_join(tree.layers[depth], at, [*tree.keys, "block"])
        if depth:
            above = _members(blocks, tree.keys, block_levels)
    return blocks


def manifest(docs: DataFrame, claimed: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof, folded_root, verified.

    ``proof`` holds the siblings from the leaf to the root, as hex. ``claimed`` is a text to hold
    against the manifest in place of a row's own; ``folded_root`` follows from that text's leaf
    and the proof, and ``verified`` says whether it is the root.

    Defined for every input: null source is a source, the first; a null id comes first in its
    source; rows of one id are ordered by their digests and repeated rows are leaves of their
    own; texts of any length are digested whole by Spark and leave as 32 bytes; an empty table
    gives an empty result; columns other than doc_id, source, lang, n_chars and text are not read.
    A row of a block, and so what a task holds at once, has at most ``3 ** block_levels`` leaves.
    """
    own = [F.col(c) for c in COLUMNS]
    leaf = F.unhex(row_digest(own))
    text = F.col("text").cast("string")
    if claimed is None:
        other = F.lit(None).cast("binary")
    else:
        other = F.when(~claimed.eqNullSafe(text), F.unhex(row_digest([*own[:-1], claimed])))
    rows = docs.select(*[F.col(c) for c in COLUMNS]).select(
        F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("digest"), other.alias("other")
    )
    placed = with_position(rows, ["source"], ["doc_id", "digest", "other"])
    leaves = placed.select("source", "position", "digest", F.struct("doc_id", "other").alias("payload"))
    sources = build_tree(leaves, ["source"], block_levels)

    roots = with_position(sources.roots(), [], ["source"])
    whole = F.lit(0).alias("tree")
    nodes = roots.select(whole, "position", "digest", F.lit(None).cast("int").alias("payload"))
    top = build_tree(nodes, ["tree"], block_levels)
    root = stored(top.roots(), "merkle").select(
        "tree", F.lit(0).cast("long").alias("position"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"),
        F.expr("filter(array(named_struct('run', digest, 'slot', 0)), x -> false)").alias("path"),
    )
    in_top = stored(_members(with_paths(top, root, block_levels), ["tree"], block_levels), "merkle")
    below = null_safe_join(roots, in_top.select("position", "path", "root"), ["position"])
    named = stored(below.select("source", F.lit(0).cast("long").alias("position"), "path", F.col("digest").alias("subroot"), "root"), "merkle")
    blocks = with_paths(sources, named, block_levels)

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, levels, digests, subroot, root = (batch.column(c)[i].as_py() for c in ("n", "levels", "digests", "subroot", "root"))
                above = [(p["run"], p["slot"]) for p in batch.column("above")[i].as_py()]
                tail, upper = siblings(above), {}
                out: dict[str, list] = {c: [] for c in ("doc_id", "leaf", "proof", "folded_root", "verified")}
                leaf_at = addresses(n, levels)[0].tolist()
                for leaf, payload in enumerate(batch.column("payload")[i].as_py()):
                    own = digests[_SIZE * leaf_at[leaf]:_SIZE * leaf_at[leaf] + _SIZE]
                    path = block_path(digests, n, levels, leaf)
                    reached = fold(own if payload["other"] is None else payload["other"], path)
                    if reached not in upper:  # nearly all leaves of a block reach its root
                        upper[reached] = fold(reached, above)
                    out["doc_id"].append(payload["doc_id"])
                    out["leaf"].append(own.hex())
                    out["proof"].append(siblings(path) + tail)
                    out["folded_root"].append(upper[reached].hex())
                    out["verified"].append(upper[reached] == root)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["doc_id"], pa.int64()), pa.array(out["leaf"], pa.string()), pa.array([subroot.hex()] * n, pa.string()),
                     pa.array([root.hex()] * n, pa.string()), pa.array(out["proof"], pa.string()), pa.array(out["folded_root"], pa.string()),
                     pa.array(out["verified"], pa.bool_())],
                    names=["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"],
                )

    return blocks.mapInArrow(proofs, "doc_id bigint, leaf string, subroot string, root string, proof string, folded_root string, verified boolean")
