"""Prefix trie of conversations, built as a burst trie.

A turn becomes the first 16 bytes of the SHA-256 of its role and text, a conversation the
row of its turn ids. Equal conversations are one weighted row. Containers hold suffixes
under a trie head, the prefix they share; the shards of a container table are its
partitions. A container with more than ``ROOM`` turns and more than one suffix bursts: the
turns that all its suffixes begin with become a path of nodes, and each suffix goes on into
the container of its next turn id. So a burst always splits, whatever the suffixes share.
Containers that are small enough, or hold a single suffix, are sorted, and a sweep over
neighbours gives their nodes. Sums of subtrees go up from swept containers over the bursts.

A task holds one container: ``ROOM`` turns, or a single conversation. A conversation is one
row of 20 bytes a turn, so that its length is bounded by Spark's rows (tens of millions of turns).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import small_batches, spread_join
from headway.session import materialise

ROOM = 1 << 15
WIDTH = 16
CHUNK = 4096
EMPTY = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
_NODE = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
     ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
)


def _truncated(value: Column) -> Column:
    """The first 16 bytes of the SHA-256, in hexadecimal digits."""
    return F.substring(F.sha2(value, 256), 1, 2 * WIDTH)


def turns_of(rows: DataFrame) -> DataFrame:
    """Conversations as (conv_id, turns): array of (id, length), ordered by turn.

    Null turns come first, and turns of one number are ordered by their id. Null role or text is
    empty. Rows without conv_id belong to no conversation and are left out.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    coded = _truncated(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    one = rows.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), coded.alias("id"), F.length(text).alias("n")).alias("t"),
    )
    listed = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["n"].alias("n"))).alias("turns"))


def _encoded(turns: Column) -> list[Column]:
    ids = F.unhex(F.array_join(F.transform(turns, lambda t: t["id"]), ""))
    return [ids.alias("ids"), F.transform(turns, lambda t: t["n"]).alias("lens")]


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) as (conv_id, ids, lens): one binary of turn ids and the turns' code points."""
    return conversations.select("conv_id", *_encoded(F.col("turns")))


def weighted(rows: DataFrame) -> DataFrame:
    """Distinct sequences (conv, n, ends, ids, lens): smallest conversation, number, digest of all.

    The digest is that of the ascending ids of the equal conversations. These are range-sorted and
    joined in chunks, and only chunks meet: one task reads a row for ``CHUNK`` conversations.
    """
    rows = materialise(rows.withColumn("seq", F.unhex(F.sha2("ids", 256))), "trie-sequences")
    groups = rows.groupBy("seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    groups = materialise(groups, "trie-groups")
    several = groups.filter("n > 1").select("seq", "n")
    members = spread_join(rows.select("seq", "conv_id"), several, "seq", "n").select("seq", "conv_id")
    ends = F.coalesce("ends", F.sha2(F.col("conv").cast("string"), 256)).alias("ends")
    first = groups.withColumnRenamed("conv", "conv_id")
    return rows.join(first, ["seq", "conv_id"]).join(_joined_ids(members), "seq", "left").withColumnRenamed(
        "conv_id", "conv"
    ).select("conv", "n", ends, "ids", "lens")


def _joined_ids(members: DataFrame) -> DataFrame:
    """(seq, ends): SHA-256 of the ascending conv_ids of each sequence, comma-joined."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seq", pa.binary()), ("first", pa.int64()), ("listed", pa.string())])
        pairs = (p for b in batches for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        out = []
        for seq, group in groupby(pairs, key=lambda p: p[0]):
            held = []
            for _, conv in group:
                held.append(conv)
                if len(held) == CHUNK:
                    out.append((seq, held[0], ",".join(map(str, held))))
                    held = []
            if held:
                out.append((seq, held[0], ",".join(map(str, held))))
            if len(out) >= 1000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seq", pa.binary()), ("ends", pa.string())])
        rows = (p for b in batches for p in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True))
        out = []
        for seq, group in groupby(rows, key=lambda p: p[0]):
            digest = hashlib.sha256()
            for k, (_, listed) in enumerate(group):
                digest.update((b"," if k else b"") + listed.encode())
            out.append((seq, digest.hexdigest()))
            if len(out) == 1000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    sorted_parts = members.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    chunked = sorted_parts.mapInArrow(chunks, "seq binary, first long, listed string")
    together = chunked.repartition("seq").sortWithinPartitions("seq", "first")
    return together.mapInArrow(hashed, "seq binary, ends string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


# ---- containers

def _common(low: Column, high: Column) -> Column:
    """Turns that the smallest and the largest suffix, and so all between them, begin with."""

    @F.udf("int", useArrow=True)
    def common(low: bytes, high: bytes) -> int:
        return _shared(low, high)

    return common(low, high)


def _shared(a: bytes, b: bytes) -> int:
    """Number of turn ids at the start of both."""
    most = min(len(a), len(b)) // WIDTH
    if a[: most * WIDTH] == b[: most * WIDTH]:
        return most
    low, high = 0, most  # the first `low` are equal, the first `high` are not
    while high - low > 1:
        middle = (low + high) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle
    return low


def burst(rows: DataFrame, room: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Containers that are to be swept, and the heads that burst, by round.

    ``rows`` are the distinct sequences. Settled rows: head, depth, up (smallest conversation of the
    head's node), parent, conv, n, ends, ids, lens. Heads: head, depth, up, parent, conv, n, path
    lengths, digest of the conversations that end at its last node. Depth is that above the first id.
    """
    start = F.lit(b"").cast("binary")
    none = F.lit(None).cast("binary").alias("parent")
    columns = ["conv", "n", "ends", "ids", "lens"]
    open_rows = rows.select(
        start.alias("head"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("up"), none, *columns
    )
    settled, heads = [], []
    while True:
        first_round = not heads
        open_rows = materialise(open_rows, "trie-open")
        sizes = open_rows.groupBy("head").agg(
            F.count("*").alias("suffixes"), F.sum(F.size("lens") + 1).alias("turns"), F.first("depth").alias("depth"),
            F.first("up").alias("up"), F.first("parent").alias("parent"), F.min("conv").alias("smallest"),
            F.sum("n").alias("convs"),
        )
        large = F.lit(True) if first_round else (F.col("suffixes") > 1) & (F.col("turns") > room)
        sizes = materialise(sizes.withColumn("large", large), "trie-sizes")
        over = sizes.filter("large")
        if over.isEmpty():
            settled.append(open_rows)
            return settled, heads
        inside = spread_join(open_rows, over.select("head", "suffixes", F.lit(True).alias("_over")), "head", "suffixes")
        if not first_round:
            # few large containers: their heads are joined by broadcast or by a shuffle of the rest
            settled.append(_outside(open_rows, over))
        ends = inside.groupBy("head").agg(
            F.min(F.struct("ids", "lens", "ends")).alias("low"), F.max("ids").alias("high")
        )
        shared = F.lit(0) if first_round else _common(F.col("low.ids"), F.col("high"))
        ends = ends.select("head", "low", shared.alias("shared"))
        ended = F.octet_length("low.ids") == F.col("shared") * WIDTH
        found = over.join(ends, "head").select(
            "head", "depth", "up", "parent", F.col("smallest").alias("conv"), F.col("convs").alias("n"), "suffixes",
            "shared", F.slice("low.lens", 1, F.col("shared")).alias("lens"),
            F.when(ended, F.col("low.ends")).otherwise(F.lit(EMPTY)).alias("ends"),
        )
        found = materialise(found, "trie-heads")
        heads.append(found)
        points = found.select(
            "head", "suffixes", "shared", F.col("depth").alias("_depth"), F.col("conv").alias("_conv")
        )
        going = spread_join(open_rows.drop("up", "parent", "depth"), points, "head", "suffixes")
        going = going.filter(F.octet_length("ids") > F.col("shared") * WIDTH)
        prefix = F.expr(f"substring(ids, 1, {WIDTH} * (shared + 1))")
        open_rows = going.select(
            F.unhex(_truncated(F.concat("head", prefix))).alias("next"), (F.col("_depth") + F.col("shared")).alias("depth"),
            F.col("_conv").alias("up"), F.col("head").alias("parent"), "conv", "n", "ends",
            F.expr(f"substring(ids, {WIDTH} * shared + 1)").alias("ids"),
            F.expr("slice(lens, shared + 1, size(lens) - shared)").alias("lens"),
        ).withColumnRenamed("next", "head")


def _outside(rows: DataFrame, over: DataFrame) -> DataFrame:
    """Rows of containers that stay; there are no more large ones than turns / ROOM."""
    keys = over.select("head", "suffixes")
    total = keys.agg(F.sum("suffixes")).first()[0]
    hot = F.broadcast(keys.filter(F.col("suffixes") > total / 1000).select("head"))
    cold = keys.filter(F.col("suffixes") <= total / 1000).select("head")
    return rows.join(hot, "head", "left_anti").join(cold, "head", "left_anti")


_SWEPT = pa.schema(
    [("head", pa.binary()), ("parent", pa.binary()), ("leaves", pa.int64()), ("saved", pa.int64()), *_NODE]
)
_SWEPT_SQL = f"head binary, parent binary, leaves long, saved long, {NODE}"


def _swept(head: bytes, parent: bytes, depth: int, up: int | None, rows: list[tuple]) -> Iterator[tuple]:
    """Nodes of one container from its sorted suffixes (conv, n, ends, ids, lens), and a row of its sums."""
    # a node: conv, depth, its parent, convs, children, leaves, saved, ends, length of the turn
    path, nodes, before = [], [], b""
    for conv, n, ends, ids, lens in rows:
        shared = _shared(before, ids)
        del path[shared:]
        for k in range(shared, len(lens)):
            node = [conv, depth + k + 1, path[-1] if path else None, 0, 0, 0, 0, EMPTY, lens[k]]
            if path:
                path[-1][4] += 1
            path.append(node)
            nodes.append(node)
        for node in path:
            node[0], node[3] = min(node[0], conv), node[3] + n
        path[-1][7] = ends
        before = ids
    for node in reversed(nodes):  # children come behind their parents
        node[5] += node[4] == 0
        node[6] += (node[3] - 1) * node[8]
        if node[2]:
            node[2][5] += node[5]
            node[2][6] += node[6]
    none = (None,) * 4
    for conv, at, above, convs, children, leaves, saved, ends, _ in nodes:
        yield *none, conv, at, above[0] if above else up, convs, children, leaves, saved, ends
    top = nodes[0]  # all suffixes of a container begin with one turn
    yield head, parent, top[5], top[6], *(None,) * 8


def sweep(settled: DataFrame) -> DataFrame:
    """Nodes (columns of NODE) and, with a head, the sums of each container."""
    names = ["head", "ids", "parent", "depth", "up", "conv", "n", "ends", "lens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out = []
        for head, group in groupby(rows, key=lambda r: r[0]):
            held = list(group)
            _, _, parent, depth, up, *_ = held[0]
            suffixes = [(conv, n, ends, ids, lens) for _, ids, _, _, _, conv, n, ends, lens in held]
            for row in _swept(head, parent, depth, up, suffixes):
                out.append(row)
                if len(out) == 4000:
                    yield _batch(out, _SWEPT)
                    out = []
        if out:
            yield _batch(out, _SWEPT)

    dealt = settled.select(names).repartition("head").sortWithinPartitions("head", "ids")
    return dealt.mapInArrow(work, _SWEPT_SQL)


def _paths(heads: DataFrame) -> DataFrame:
    """Nodes of burst heads, with the sums of the containers below them, and each head's own sums."""
    names = ["head", "parent", "depth", "up", "conv", "n", "lens", "ends", "children", "leaves", "saved"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for head, parent, depth, up, conv, n, lens, ends, children, leaves, saved in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                leaves = leaves or 1
                if not lens:  # the root
                    out.append((*(None,) * 4, conv, depth, up, n, children or 0, leaves, saved or 0, ends))
                saved = saved or 0
                for k in range(len(lens) - 1, -1, -1):
                    saved += (n - 1) * lens[k]
                    last = k == len(lens) - 1
                    out.append((
                        *(None,) * 4, conv, depth + k + 1, conv if k else up, n, children if last else 1, leaves, saved,
                        ends if last else EMPTY,
                    ))
                out.append((head, parent, leaves, saved, *(None,) * 8))
            if out:
                yield _batch(out, _SWEPT)

    return heads.select(names).mapInArrow(work, _SWEPT_SQL)


def trie(conversations: DataFrame, room: int = ROOM) -> DataFrame:
    """One row per trie node (columns of NODE) of conversations (conv_id, ids, lens).

    A node is a distinct sequence of turns at the start of some conversation; the root is the
    empty one. conv_id is the smallest member, n_convs the members, n_leaves the childless
    nodes of the subtree, saved_tokens the sum over the subtree of (n_convs - 1) times the code
    points of the last turn, ends_sha256 the digest of the conversations that end at the node.
    A conversation without turns ends at the root. No conversations give no nodes. conv_id must be
    unique and not null.
    """
    small_batches(conversations)
    settled, heads = burst(weighted(conversations), room)
    swept = materialise(sweep(reduce(DataFrame.unionByName, settled)), "trie-swept")
    parts = [swept]
    for found in reversed(heads):
        below = reduce(DataFrame.unionByName, [p.select("parent", "leaves", "saved") for p in parts])
        sums = below.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("head")).agg(
            F.count("*").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        )
        parts.append(materialise(_paths(found.join(sums, "head", "left")), "trie-paths"))
    names = [f.name for f in _NODE]
    return reduce(DataFrame.unionByName, [p.filter("conv_id is not null").select(names) for p in parts])


# ---- conversations that go on from another one's start

def regrown(conversations: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversations (conv_id, turns) rebuilt: the first h turns of conversation c - c % block, then
    the own turns behind the first h, with h = CRC-32 of the decimal c, modulo ``most``.

    All of the other's turns if it has fewer, none if it is absent; a conversation may end up empty.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    own = conversations.select(
        "conv_id", F.col("turns").alias("own"), h.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("start")
    )
    donors = conversations.filter(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("start"), F.slice("turns", 1, most).alias("given")
    )
    given = F.expr("coalesce(slice(given, 1, h), slice(own, 1, 0))")
    rest = F.expr("slice(own, h + 1, greatest(size(own) - h, 0))")
    return own.join(donors, "start", "left").select("conv_id", F.concat(given, rest).alias("turns"))
