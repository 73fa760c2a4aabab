"""Exact duplicates through a cuckoo-filter index of text digests.

The index is dealt over buckets by digest prefix. Each bucket has a cuckoo filter of short
fingerprints and the stored keys (digest, byte length, largest row, row count). A new
digest that misses the filter is new; a hit is verified against the bucket's stored
content keys, because filters err. Deletion takes a fingerprint out again. When an
insertion overflows, the filter is doubled and filled anew from the stored keys.

The live rows lie beside the buckets, counted per digest and id, so that after a deletion
the largest row that is left is found however many rows share a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from headway.llm.common import small_batches
from headway.session import materialise

SLOTS = 4
MAX_KICKS = 200
SALTS = 32
INDEX = "bucket int, digest binary, n_bytes long, doc_id long, rid long, n long"
STORED_RID = -1  # of all stored rows: row numbers start anew with each batch


@dataclass
class Index:
    """The stored keys (INDEX columns) and the live rows (digest, n_bytes, doc_id, n)."""

    keys: DataFrame
    live: DataFrame

    def collect(self) -> list[Row]:
        return self.keys.collect()


class CuckooFilter:
    """A filter of 16-bit fingerprints with two candidate cells of four slots per key."""

    def __init__(self, cells: int = 64):
        self.cells = 1 << max(1, (cells - 1).bit_length())
        self.table = [[] for _ in range(self.cells)]

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "big") or 1
        first = int.from_bytes(digest[10:18], "big") & (self.cells - 1)
        return mark, first, first ^ self._step(mark)

    def _step(self, mark: int) -> int:
        return (mark * 0x5BD1E995) & (self.cells - 1)

    def __contains__(self, digest: bytes) -> bool:
        mark, one, two = self._places(digest)
        return mark in self.table[one] or mark in self.table[two]

    def add(self, digest: bytes) -> bool:
        """False if no place was found; the filter must then be rebuilt larger."""
        mark, one, two = self._places(digest)
        for cell in (one, two):
            if len(self.table[cell]) < SLOTS:
                self.table[cell].append(mark)
                return True
        cell = one
        for kick in range(MAX_KICKS):
            self.table[cell].append(mark)
            mark = self.table[cell].pop(kick % SLOTS)
            cell ^= self._step(mark)
            if len(self.table[cell]) < SLOTS:
                self.table[cell].append(mark)
                return True
        return False

    def remove(self, digest: bytes) -> None:
        mark, one, two = self._places(digest)
        for cell in (one, two):
            if mark in self.table[cell]:
                self.table[cell].remove(mark)
                return


def _larger(a: tuple, b: tuple) -> tuple:
    """Of (doc_id, rid) the larger; null ids are smaller than any other."""
    return max(a, b, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))


class Bucket:
    """One bucket of the index: the filter, and the stored keys it stands for."""

    def __init__(self):
        self.filter = CuckooFilter()
        self.keys: dict[tuple[bytes, int], tuple[tuple, int]] = {}

    def insert(self, digest: bytes, n_bytes: int, best: tuple, n: int) -> None:
        key = (digest, n_bytes)
        if digest in self.filter and (held := self.keys.get(key)):
            self.keys[key] = (_larger(held[0], best), held[1] + n)
            return
        self.keys[key] = (best, n)
        if not self.filter.add(digest):
            self.resize()

    def delete(self, digest: bytes, n_bytes: int, n: int) -> None:
        """Take ``n`` rows of a digest out; the key goes with its last row."""
        key = (digest, n_bytes)
        if digest not in self.filter or not (held := self.keys.get(key)):
            return
        if held[1] > n:
            self.keys[key] = (held[0], held[1] - n)
        else:
            del self.keys[key]
            self.filter.remove(digest)

    def settle(self, digest: bytes, n_bytes: int, best: tuple) -> None:
        """Record the largest live row of a digest."""
        key = (digest, n_bytes)
        if held := self.keys.get(key):
            self.keys[key] = (best, held[1])

    def resize(self) -> None:
        cells = self.filter.cells
        done = False
        while not done:
            cells *= 2
            self.filter = CuckooFilter(cells)
            done = all(self.filter.add(digest) for digest, _ in self.keys)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, digest, n_bytes, part): one narrow row per document, written once.

    ``rid`` numbers the rows, which tells repeated ids apart; ``part`` is a salt that
    spreads the rows of a frequent text.
    """
    small_batches(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("rid"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    return materialise(rows, "digests").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "rid"), F.lit(SALTS)).cast("int")
    )


def _changes(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows summed per digest and salt before they are dealt to the buckets."""
    best = F.max(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "rid")).alias("best")
    n = F.sum("n") if "n" in rows.columns else F.count("*")
    sums = rows.groupBy("digest", "n_bytes", "part").agg(best, n.alias("n"))
    prefix = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return sums.select(
        F.pmod(prefix, F.lit(buckets)).cast("int").alias("bucket"),
        "digest", "n_bytes", "part", "best.doc_id", "best.rid", "n",
    )


def _in_buckets(changes: DataFrame, stored: Index | None) -> DataFrame:
    """Stored keys (op 0), deletions (op 1), insertions (op 2), largest live rows (op 3), bucket by bucket."""
    names = ["bucket", "op", "digest", "n_bytes", "part", "doc_id", "rid", "n"]
    if stored is not None:
        held = stored.keys.withColumns(
            {"op": F.lit(0), "part": F.lit(0), "rid": F.lit(STORED_RID).cast("long")}
        )
        changes = changes.select(names).unionByName(held.select(names))
    return changes.select(names).repartition("bucket").sortWithinPartitions("bucket", "op")


def _run(rows: DataFrame, emit, schema: str) -> DataFrame:
    """Apply the changes of each bucket in turn; ``emit`` gives the columns of a finished bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bucket, seen = None, Bucket(), []
        for batch in batches:
            for number, op, digest, n_bytes, part, doc_id, rid, n in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if number != now:
                    if now is not None:
                        yield from emit(now, bucket, seen)
                    now, bucket, seen = number, Bucket(), []
                if op == 1:
                    bucket.delete(digest, n_bytes, n)
                elif op == 3:
                    bucket.settle(digest, n_bytes, (doc_id, rid))
                else:
                    bucket.insert(digest, n_bytes, (doc_id, rid), n)
                    if op == 2:
                        seen.append((digest, n_bytes, part))
        if now is not None:
            yield from emit(now, bucket, seen)

    return rows.mapInArrow(work, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


_KEYS = pa.schema(
    [("bucket", pa.int32()), ("digest", pa.binary()), ("n_bytes", pa.int64()), ("doc_id", pa.int64()),
     ("rid", pa.int64()), ("n", pa.int64())]
)
_FOUND = pa.schema(
    [("digest", pa.binary()), ("n_bytes", pa.int64()), ("part", pa.int32()), ("keep_id", pa.int64()),
     ("keep_rid", pa.int64()), ("group_size", pa.int64())]
)


def bucket_count(rows: DataFrame) -> int:
    """Buckets of about ten thousand rows, so that a bucket fits a task at any size."""
    return max(16, rows.count() // 10_000)


def update(
    stored: Index | None, inserted: DataFrame | None, deleted: DataFrame | None, buckets: int
) -> Index:
    """The index after deletions, then insertions, written.

    ``inserted`` and ``deleted`` come from :func:`digests`. A deletion takes out live rows of
    its text and id; one that finds none does nothing. The recorded row is the largest live one.
    """
    key = ["digest", "n_bytes", "doc_id"]
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = (
        (stored and stored.live, F.col("n"), none, none), (inserted, none, one, none), (deleted, none, none, one),
    )
    parts = [
        rows.select(*key, held.alias("held"), more.alias("more"), less.alias("less"))
        for rows, held, more, less in sides
        if rows is not None
    ]
    sums = reduce(DataFrame.unionByName, parts).groupBy(key).agg(*[F.sum(c).alias(c) for c in ("held", "more", "less")])
    gone = F.least("held", "less").alias("gone")
    sums = materialise(sums.select(*key, gone, (F.col("held") - gone + F.col("more")).alias("n")), "live-changes")
    live = materialise(sums.filter("n > 0").select(*key, "n"), "live-rows")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("part")
    rid = F.lit(STORED_RID).cast("long").alias("rid")

    def change(rows: DataFrame, n: str, op: int) -> DataFrame:
        return _changes(rows.select(*key, rid, part, F.col(n).alias("n")), buckets).withColumn("op", F.lit(op))

    changes = []
    if deleted is not None:
        changes.append(change(sums.filter("gone > 0"), "gone", 1))
    if inserted is not None:
        changes.append(_changes(inserted, buckets).withColumn("op", F.lit(2)))
    if deleted is not None:
        best = change(live, "n", 3)
        best = best.groupBy("bucket", "digest", "n_bytes", "op").agg(
            F.max(F.struct(F.col("doc_id").isNotNull().alias("some"), "doc_id", "rid")).alias("best"), F.sum("n").alias("n")
        )
        changes.append(best.select("bucket", "digest", "n_bytes", F.lit(0).alias("part"), "best.doc_id", "best.rid", "n", "op"))

    def emit(number, bucket, _):
        rows = [(number, d, b, best[0], best[1], n) for (d, b), (best, n) in bucket.keys.items()]
        yield from _batch(rows, _KEYS)

    every = reduce(DataFrame.unionByName, changes)
    return Index(materialise(_run(_in_buckets(every, stored), emit, INDEX), "digest-index"), live)


def duplicates(docs: DataFrame, stored: Index | None = None, buckets: int | None = None) -> DataFrame:
    """One row per document: doc_id, digest, keep_id, group_size, kept.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the
    largest doc_id stays; null ids are smaller than any other, and of repeated ids one row
    stays. With ``stored`` the live rows of the index take part in the comparison; of a row
    given and a stored one with equal ids the one given stays.
    """
    rows = digests(docs)
    buckets = buckets or bucket_count(rows)
    changes = _changes(rows, buckets).withColumn("op", F.lit(2))

    def emit(_, bucket, seen):
        found = [(d, b, part, *bucket.keys[d, b][0], bucket.keys[d, b][1]) for d, b, part in seen]
        yield from _batch(found, _FOUND)

    schema = "digest binary, n_bytes long, part int, keep_id long, keep_rid long, group_size long"
    found = _run(_in_buckets(changes, stored), emit, schema)
    return rows.join(found, ["digest", "n_bytes", "part"]).select(
        "doc_id", "digest", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("rid") == F.col("keep_rid"))).alias("kept"),
    )
