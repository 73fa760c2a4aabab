"""Merkle manifest of a dataset, its nodes stored in van Emde Boas order.

Every row is a leaf, every source a tree of arity 16, and the roots of the sources are the
leaves of a last tree. A tree of L node levels is split at half height: the upper half is
stored first, behind it the lower subtrees from left to right, and each of them is split in
the same way. So any aligned subtree is one run of addresses, whatever its height, and
:func:`address` gives the place of a node from its depth and index alone.

Splitting stops for storage at subtrees of ``BLOCK_LEVELS`` levels: one row of the manifest.
Construction makes the lowest blocks in tasks of their own and goes on over the block roots;
retrieval comes down the same way: the siblings of a block root lie in the neighbouring
blocks under one parent, all others in the block itself. A task holds one block.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from headway.llm.common import small_batches
from headway.operators.ordering import numbered
from headway.session import lookup_join, materialise

BITS = 4
ARITY = 1 << BITS
BLOCK_LEVELS = 3
MOST_LEVELS = 15  # of a tree: 16 ** 14 leaves
WIDTH = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ROOTS = ""  # the tree above the sources


# ---- addresses

def nodes_in(levels: int) -> int:
    """Nodes of a complete tree with so many levels."""
    return ((1 << BITS * levels) - 1) // (ARITY - 1)


def levels_of(leaves: int) -> int:
    """Levels of the smallest tree with so many leaves; a lone leaf is a tree of one level."""
    levels = 1
    while 1 << BITS * (levels - 1) < leaves:
        levels += 1
    return levels


def address(levels: int, depth: int, index):
    """Place of node ``index`` (a number or an array) at ``depth`` below the root in van Emde Boas order."""
    if levels == 1:
        return index * 0
    lower = levels // 2
    upper = levels - lower
    if depth < upper:
        return address(upper, depth, index)
    below = BITS * (depth - upper)
    tree = index >> below
    return nodes_in(upper) + tree * nodes_in(lower) + address(lower, depth - upper, index - (tree << below))


def heights(levels: int) -> list[int]:
    """Levels of the stored blocks on the way from a leaf to the root."""
    if levels <= BLOCK_LEVELS:
        return [levels]
    lower = levels // 2
    return heights(lower) + heights(levels - lower)


def block_of(levels: int, step: int, index):
    """Address of the block that takes node ``index`` in construction step ``step``, and its root's index.

    The nodes of step 0 are the leaves; those of a later step are the block roots of the one before,
    whose runs of sixteen are the lowest nodes of the block.
    """
    high = heights(levels)
    root = index >> BITS * (high[step] - (step == 0))
    return address(levels, levels - sum(high[: step + 1]), root), root


# ---- blocks

def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _runs(nodes: list[str]) -> list[str]:
    return [digest(nodes[k : k + ARITY]) for k in range(0, len(nodes), ARITY)]


class Block:
    """An aligned subtree: ``lowest`` nodes of its last level, and all digests in van Emde Boas order."""

    def __init__(self, levels: int, lowest: int, digests: bytes):
        self.levels, self.lowest, self.hex = levels, lowest, digests.hex()

    @staticmethod
    def build(levels: int, nodes: list[str]) -> Block:
        out, lowest = bytearray(nodes_in(levels) * WIDTH), len(nodes)
        for depth in range(levels - 1, -1, -1):
            for index, node in enumerate(nodes):
                at = address(levels, depth, index) * WIDTH
                out[at : at + WIDTH] = bytes.fromhex(node)
            if depth:
                nodes = _runs(nodes)
        return Block(levels, lowest, bytes(out))

    @property
    def root(self) -> str:
        return self.hex[: 2 * WIDTH]

    def node(self, depth: int, index: int) -> str:
        at = address(self.levels, depth, index) * 2 * WIDTH
        return self.hex[at : at + 2 * WIDTH]

    def path(self, index: int) -> list[tuple[int, list[str]]]:
        """Place in the run and the run's other nodes, from a lowest node up to below the root."""
        out = []
        for depth in range(self.levels - 1, 0, -1):
            there = -(-self.lowest >> BITS * (self.levels - 1 - depth))  # nodes of this level, rounded up
            first = index & -ARITY
            run = [self.node(depth, k) for k in range(first, min(first + ARITY, there))]
            place = index - first
            out.append((place, run[:place] + run[place + 1 :]))
            index >>= BITS
        return out


def pack(path: list[tuple[int, list[str]]]) -> bytes:
    return b"".join(struct.pack("BB", place, len(run)) + bytes.fromhex("".join(run)) for place, run in path)


def unpack(path: bytes) -> list[tuple[int, list[str]]]:
    out, at = [], 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        text = path[at + 2 : at + 2 + n * WIDTH].hex()
        out.append((place, [text[k : k + 2 * WIDTH] for k in range(0, len(text), 2 * WIDTH)]))
        at += 2 + n * WIDTH
    return out


def fold(leaf: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for place, run in path:
        leaf = digest([*run[:place], leaf, *run[place:]])
    return leaf


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of a sorted partition by their first two columns."""
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return groupby(rows, key=lambda row: row[:2])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of one block together and in order; a block has 16 ** BLOCK_LEVELS rows at most."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "index")


def _place(step: int, part: int, levels: Column, index: Column) -> Column:
    """Block address (part 0) or index of the block root (part 1) of a node in a construction step."""

    @F.pandas_udf("long")
    def place(levels: pd.Series, index: pd.Series) -> pd.Series:
        out = np.zeros(len(index), dtype=np.int64)
        of, at = levels.to_numpy(), index.to_numpy()
        for n in np.unique(of):
            out[of == n] = block_of(int(n), step, at[of == n])[part]
        return pd.Series(out)

    return place(levels, index)


_BUILT = pa.schema(
    [("tree", pa.string()), ("block", pa.int64()), ("levels", pa.int32()), ("index", pa.int64()),
     ("height", pa.int32()), ("lowest", pa.int32()), ("digests", pa.binary()), ("root", pa.string())]
)
_BUILT_SQL = "tree string, block long, levels int, index long, height int, lowest int, digests binary, root string"


def _step(nodes: DataFrame, step: int) -> DataFrame:
    """The blocks over nodes (tree, levels, index, digest) of one construction step."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks():
            for (tree, block), rows in _groups(batches):
                held = list(rows)
                levels, first = held[0][3], held[0][2]
                height = heights(levels)[step]
                nodes = [row[4] for row in held]
                if step:
                    nodes = _runs(nodes)
                built = Block.build(height, nodes)
                index = block_of(levels, step, first)[1]
                yield tree, block, levels, index, height, built.lowest, bytes.fromhex(built.hex), built.root

        yield from _batches(blocks(), _BUILT, 200)

    rows = nodes.select(
        "tree", _place(step, 0, F.col("levels"), F.col("index")).alias("block"), "index", "levels", "digest"
    )
    return _dealt(rows).mapInArrow(work, _BUILT_SQL)


def forest(nodes: DataFrame, most_levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The written blocks of each construction step over the leaves (tree, levels, index, digest), and
    the root of each tree (tree, root)."""
    steps, roots = [], []
    for step in range(max(len(heights(n)) for n in range(1, most_levels + 1))):
        built = materialise(_step(nodes, step), "merkle-blocks")
        steps.append(built)
        last = F.lit(step + 1) == _steps(F.col("levels"))
        roots.append(built.filter(last).select("tree", "root"))
        nodes = built.filter(~last).select("tree", "levels", "index", F.col("root").alias("digest"))
    return steps, reduce(DataFrame.unionByName, roots)


def _steps(levels: Column) -> Column:
    return F.element_at(F.array(*[F.lit(len(heights(n))) for n in range(1, MOST_LEVELS + 1)]), levels)


_PATHS = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("path", pa.binary())])


def _paths(steps: list[DataFrame], above: DataFrame) -> DataFrame:
    """Path from the root of every lowest block to the last root: (tree, block, path).

    ``above`` (tree, path) continues the path from the root of each tree. Comes down over
    the steps: a task has one block, its own path, and the block roots it was made from.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for (tree, _), rows in _groups(batches):
                _, _, _, height, lowest, digests, upward, _, _ = next(rows)
                block = Block(height, lowest, digests)
                rows = list(rows)  # the block roots below, in order
                first = rows[0][2]
                inner = {}
                for at in range(0, len(rows), ARITY):
                    run = [row[7] for row in rows[at : at + ARITY]]
                    node = at >> BITS
                    inner[node] = pack(block.path(node)) + upward
                    for k, row in enumerate(rows[at : at + ARITY]):
                        yield tree, row[8], pack([(k, run[:k] + run[k + 1 :])]) + inner[node]
                assert first % ARITY == 0

        yield from _batches(found(), _PATHS, 500)

    paths = None
    for step in range(len(steps) - 1, -1, -1):
        last = F.lit(step + 1) == _steps(F.col("levels"))
        top = lookup_join(steps[step].filter(last).select("tree", "block"), above, ["tree"])
        if paths is None:
            paths = top
        else:
            upper = steps[step + 1].join(paths, ["tree", "block"]).select(
                "tree", "block", F.lit(-1).cast("long").alias("index"), "height", "lowest", "digests", "path",
                F.lit(None).cast("string").alias("root"), F.lit(None).cast("long").alias("child"),
            )
            lower = steps[step].filter(~last).select(
                "tree", _place(step + 1, 0, F.col("levels"), F.col("index")).alias("block"), "index",
                F.lit(None).cast("int").alias("height"), F.lit(None).cast("int").alias("lowest"),
                F.lit(None).cast("binary").alias("digests"), F.lit(None).cast("binary").alias("path"),
                "root", F.col("block").alias("child"),
            )
            down = _dealt(upper.unionByName(lower)).mapInArrow(work, "tree string, block long, path binary")
            paths = top.unionByName(down)
        paths = materialise(paths, "merkle-paths")
    return paths


# ---- a manifest of documents

def tagged(value: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_of(text: Column) -> Column:
    """The leaf of a row with ``text`` in place of its own."""
    fields = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.sha2(F.concat(*[tagged(f) for f in fields]), 256)


@dataclass
class Manifest:
    """``leaves`` (tree, levels, index, digest, further columns), ``steps`` (blocks of the sources),
    ``trees`` (tree, leaves, levels, subroot), ``above`` (blocks of the tree over the sources), ``root``."""

    leaves: DataFrame
    steps: list[DataFrame]
    trees: DataFrame
    above: list[DataFrame]
    root: str | None

    def blocks(self) -> DataFrame:
        """All stored blocks: tree, block (its first address), height, lowest, digests."""
        columns = ["tree", "block", "height", "lowest", "digests"]
        return reduce(DataFrame.unionByName, [s.select(columns) for s in [*self.steps, *self.above]])


def _levels(leaves: Column) -> Column:
    out = F.lit(MOST_LEVELS)
    for levels in range(MOST_LEVELS - 1, 0, -1):
        out = F.when(leaves <= 1 << BITS * (levels - 1), F.lit(levels)).otherwise(out)
    return out


def manifest(docs: DataFrame, *more: Column) -> Manifest:
    """The manifest of ``docs`` (columns of ``FIELDS``); ``more`` columns go along with the leaves.

    Leaves ascend by doc_id within a source, null ids first, equal ids by their digest; rows equal
    in all fields are interchangeable. Null sources form a source of their own, which comes first.
    An empty table has no trees and the root None. Other columns of ``docs`` are not looked at.
    """
    small_batches(docs)
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    rows = docs.select(
        key.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(F.col("text")).alias("digest"), *more
    )
    table, _ = numbered(rows, [F.col("tree"), F.col("doc_id"), F.col("digest")], "merkle-leaves")
    trees = table.groupBy("tree").agg(F.min("_number").alias("start"), F.count("*").alias("leaves"))
    trees = materialise(trees.withColumn("levels", _levels(F.col("leaves"))), "merkle-trees")
    most = trees.agg(F.max("levels")).first()[0]
    if most is None:
        empty = trees.select("tree", "leaves", "levels", F.lit("").alias("subroot"), F.lit(0).alias("rank"))
        return Manifest(table.select("tree", "digest"), [], empty, [], None)
    leaves = lookup_join(table, trees.select("tree", "start", "levels"), ["tree"], how="inner")
    leaves = leaves.withColumn("index", F.col("_number") - F.col("start")).drop("_number", "start")
    steps, subroots = forest(leaves.select("tree", "levels", "index", "digest"), most)
    trees = trees.join(subroots, "tree").select("tree", "leaves", "levels", F.col("root").alias("subroot"))
    ranked, number = numbered(trees, [F.col("tree")], "merkle-subroots")
    levels = levels_of(number)
    over = ranked.select(
        F.lit(ROOTS).alias("tree"), F.lit(levels).alias("levels"), F.col("_number").alias("index"),
        F.col("subroot").alias("digest"),
    )
    above, root = forest(over, levels)
    ranked = ranked.withColumn("rank", F.col("_number")).drop("_number")
    return Manifest(leaves, steps, ranked, above, root.first()["root"])


def _retrieved(members: DataFrame, steps: list[DataFrame], above: DataFrame, columns: list[str], emit, schema: str) -> DataFrame:
    """``emit(values of columns, path to the last root)`` for every member, in the order of ``schema``.

    A lowest block, the path of its root and its members meet in one task.
    """
    blocks = steps[0].join(_paths(steps, above), ["tree", "block"])
    header = blocks.select(
        "tree", "block", F.lit(-1).cast("long").alias("index"), "height", "lowest", "digests", "path",
        *[F.lit(None).cast(members.schema[c].dataType).alias(c) for c in columns],
    )
    empty = [F.lit(None).cast(header.schema[c].dataType).alias(c) for c in ("height", "lowest", "digests", "path")]
    block = _place(0, 0, F.col("levels"), F.col("index")).alias("block")
    rows = members.select("tree", block, "index", *empty, *columns)
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for _, group in _groups(batches):
                _, _, _, height, lowest, digests, upward, *_ = next(group)
                block, upper = Block(height, lowest, digests), unpack(upward)
                width = 1 << BITS * (height - 1)
                for row in group:
                    yield emit(row[7:], block.path(row[2] % width) + upper)

        yield from _batches(found(), out)

    return _dealt(header.unionByName(rows)).mapInArrow(work, schema)


def proofs(made: Manifest, columns: list[str], emit, schema: str) -> DataFrame:
    """``emit(values, path)`` for every leaf with the named columns of ``made.leaves``.

    ``path`` lists for every level up to the root the place in the run and the siblings' digests.
    """
    spark = made.trees.sparkSession
    if made.root is None:
        return spark.createDataFrame([], schema)
    start = spark.createDataFrame([(ROOTS, b"")], "tree string, path binary")
    levels = levels_of(made.trees.count())
    subroots = made.trees.select(
        F.lit(ROOTS).alias("tree"), F.lit(levels).alias("levels"), F.col("rank").alias("index"), F.col("tree").alias("source")
    )
    over = _retrieved(
        subroots, made.above, start, ["source"], lambda row, path: (row[0], pack(path)), "tree string, path binary"
    )
    return _retrieved(made.leaves, made.steps, materialise(over, "merkle-over"), columns, emit, schema)


def verified(made: Manifest, claimed: str = "claimed") -> DataFrame:
    """Every leaf against its proof: doc_id, tree, digest, proof_sha256, folded_root, verified.

    ``claimed`` is a column of the leaves, the digest of the row as it is to be checked. The
    proof's digest is that of all siblings, from the leaf's run up to the root's.
    """
    root = made.root

    def emit(row, path):
        doc_id, tree, leaf, now = row
        folded = fold(now, path)
        return doc_id, tree, leaf, digest([d for _, run in path for d in run]), folded, folded == root

    schema = "doc_id long, tree string, digest string, proof_sha256 string, folded_root string, verified boolean"
    members = made.leaves.withColumn("source_tree", F.col("tree"))
    return proofs(Manifest(members, made.steps, made.trees, made.above, root), ["doc_id", "source_tree", "digest", claimed], emit, schema)
