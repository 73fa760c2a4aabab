"""Near duplicates by SimHash fingerprints and multi-index hashing.

Fingerprints are cut into segments. Two fingerprints within the distance agree, up to a
small radius, in one segment at least; so every fingerprint enumerates the Hamming ball of
that radius around each of its segments and looks the values up in the segment's table.
Matches are verified over all 64 bits. Copies of one fingerprint are one entry.

A segment value shared by many fingerprints (a dense cloud of near copies) is not
multiplied out: its members are compared in one task that gives a spanning forest of their
links, and beyond ``CROWD`` members they meet at the points of small balls around the
whole fingerprint, which is linear in the members. All three ways lose no link, so the
components are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import document_keys, one_of_each, small_batches, spread_join, without
from headway.llm.components import components
from headway.session import materialise

BITS = 64
SEED = 42
SEGMENTS = 3
CELL = 64  # up to so many fingerprints of one segment value are joined pairwise
CROWD = 16_384  # up to so many are compared in one task
CHUNK = 65_536  # shingles counted at once


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of the word shingles of a text as an unsigned number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        part = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in part], dtype=">u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, h, fp): the fingerprint of every document as a signed long."""

    @F.arrow_udf("long")
    def signed(texts: pa.Array) -> pa.Array:
        values = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], dtype=np.uint64)
        return pa.array(values.view(np.int64))

    return document_keys(docs, signed(F.col("text").cast("string")).alias("fp"))


def _masks(bits: int, radius: int) -> list[int]:
    return [
        sum(1 << b for b in chosen)
        for r in range(radius + 1)
        for chosen in combinations(range(bits), r)
    ]


def _segments(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(offset, bits, radius) per segment; the radii are the smallest that miss no pair."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    radius, wide = divmod(distance, segments)
    return [
        (edges[i], edges[i + 1] - edges[i], radius if i <= wide else radius - 1)
        for i in range(segments)
    ]


def _value(offset: int, bits: int) -> Column:
    return F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit((1 << bits) - 1))


def _tables(fps: DataFrame, distance: int, segments: int) -> tuple[DataFrame, DataFrame]:
    """Entries (seg, value, fp) of the segment tables, and the values every fingerprint looks up.

    A pair that differs in a segment is looked up from one end only: from the fingerprint
    that has 0 at the lowest differing bit.
    """
    entries, lookups = [], []
    for seg, (offset, bits, radius) in enumerate(_segments(distance, segments)):
        if radius >= 0:
            value = _value(offset, bits)
            entries.append(F.struct(F.lit(seg).alias("seg"), value.alias("value")))
            lookups.append(_ball(seg, value, _masks(bits, radius)))
    table = fps.select("fp", F.explode(F.array(*entries)).alias("k")).select("k.seg", "k.value", "fp")
    wanted = fps.select("fp", F.explode(F.concat(*lookups)).alias("k")).select("k.seg", "k.value", "fp")
    return table, wanted


def _ball(seg: int, value: Column, masks: list[int]) -> Column:
    """The values in a segment's ball that this fingerprint looks up."""
    ball = F.array(*[F.lit(m).cast("long") for m in masks])
    one_end = F.filter(ball, lambda m: value.bitwiseAND(m.bitwiseAND(-m)) == F.lit(0).cast("long"))
    return F.transform(
        one_end, lambda m: F.struct(F.lit(seg).alias("seg"), value.bitwiseXOR(m).alias("value"))
    )


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def spanning_links(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the fingerprints linked at ``distance`` or fewer bits."""
    rest = np.unique(values.view(np.uint64))
    a, b, queue = [], [], []
    while len(rest) or queue:
        if not queue:
            queue.append(rest[0])
            rest = rest[1:]
        node = queue.pop()
        near = np.bitwise_count(rest ^ node) <= distance
        found = rest[near]
        rest = rest[~near]
        queue.extend(found)
        a.append(np.full(len(found), node, np.uint64))
        b.append(found)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *a]).view(np.int64), np.concatenate([empty, *b]).view(np.int64)


def _crowded_links(members: DataFrame, distance: int) -> DataFrame:
    """Spanning links inside each segment value of ``members`` (seg, value, fp)."""

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                a, b = spanning_links(np.concatenate(held), distance)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            seg, value, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(fp):
                continue
            cuts = np.flatnonzero((seg[1:] != seg[:-1]) | (value[1:] != value[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(fp)], strict=True):
                if (now := (seg[lo], value[lo])) != key:
                    yield from close()
                    key, held = now, []
                held.append(fp[lo:hi].copy())
        yield from close()

    grouped = members.select("seg", "value", "fp").repartition("seg", "value")
    return grouped.sortWithinPartitions("seg", "value").mapInArrow(forests, "a long, b long")


def _meeting_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links of fingerprints that share a point of their balls; star-shaped per point.

    Within ``distance`` two balls, one of half the distance and one of the other half,
    share a point; every member of a point lies within ``distance`` of its near members.
    """
    far = distance - distance // 2
    balls = F.array(*[F.lit(m - (1 << BITS) if m >> 63 else m).cast("long") for m in _masks(BITS, far)])
    points = fps.select("fp", F.explode(balls).alias("mask")).select(
        "fp",
        F.col("fp").bitwiseXOR(F.col("mask")).alias("point"),
        (F.bit_count("mask") <= distance // 2).alias("near"),
    )
    centre = points.groupBy("point").agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("a"), F.count("*").alias("n")
    )
    stars = points.join(centre.filter("n > 1 AND a IS NOT NULL").drop("n"), "point").filter("a <> fp")
    return stars.select("a", F.col("fp").alias("b")).distinct()


def links(
    fps: DataFrame, distance: int, segments: int = SEGMENTS, cell: int = CELL, crowd: int = CROWD
) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all within ``distance``."""
    small_batches(fps)
    table, wanted = _tables(fps, distance, segments)
    heavy = materialise(
        table.groupBy("seg", "value").count().filter(F.col("count") > cell).select("seg", "value"),
        "heavy-segments",
    )
    key = ["seg", "value"]
    light = (
        wanted.select(*key, F.col("fp").alias("a"))
        .join(table.join(heavy, key, "left_anti").select(*key, F.col("fp").alias("b")), key)
        .filter((F.col("a") != F.col("b")) & (_apart("a", "b") <= distance))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    if heavy.isEmpty():
        return light
    members = materialise(
        table.unionByName(wanted).join(heavy, key, "left_semi").distinct(), "segment-members"
    )
    crowds = materialise(
        members.groupBy(*key).count().filter(F.col("count") > crowd).select(*key), "crowds"
    )
    found = light.unionByName(_crowded_links(members.join(crowds, key, "left_anti"), distance))
    if crowds.isEmpty():
        return found
    crowded = members.join(crowds, key, "left_semi").select("fp").distinct()
    return found.unionByName(_meeting_links(crowded, distance))


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, segments: int = SEGMENTS
) -> DataFrame:
    """One row per document: doc_id, h, fp, component_id, stays.

    ``component_id`` is the smallest doc_id reachable over links of ``distance`` or fewer
    bits. ``stays`` marks the row with that id (of equal ids the one with the smallest text
    hash), and rows equal to it in id and text. Null ids count as larger than any other; a
    component of null ids alone has a null component_id. Null text has no words; texts
    without words have fingerprint zero and are linked like others.
    """
    signed = materialise(fingerprints(docs, shingle), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    groups = materialise(
        signed.groupBy("fp").agg(F.min(rank).alias("rep"), F.count("*").alias("n")), "fingerprint-groups"
    )
    roots = components(links(groups.select("fp"), distance, segments))
    rooted = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", "n", F.coalesce("root", "fp").alias("root")
    )
    best = rooted.groupBy("root").agg(F.min("rep").alias("best"))
    table = materialise(rooted.join(best, "root").select("fp", "n", "best"), "fingerprint-components")
    return spread_join(signed, table, "fp", "n").select(
        "doc_id",
        "h",
        "fp",
        F.col("best.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("h") == F.col("best.h"))).alias("stays"),
    )


def deduplicated(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents with one of each component left: the one that has its smallest id."""
    found = materialise(near_duplicates(docs, shingle, distance), "near-duplicates")
    left = without(docs, found.filter("NOT stays"))
    repeated = found.filter("stays").groupBy("doc_id", "h").count().filter("count > 1")
    repeated = materialise(repeated.select("doc_id", "h"), "repeated-rows")
    return left if repeated.isEmpty() else one_of_each(left, repeated)
