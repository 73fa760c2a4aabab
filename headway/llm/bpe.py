"""Byte-level BPE as a monoid: halves are encoded by themselves and joined at their boundary.

Two homomorphisms make this exact.

*Text.* A text may be cut where a run of letters, of digits or of other marks (an apostrophe
excepted, which may begin a contraction) ends: no match of the pattern crosses such a place,
and none looks beyond it. So a stretch of text is a head before its first cut, the ids of
what lies between its cuts, and a tail behind the last one; a neighbour supplies what head and
tail lack. Stretches without any cut stay raw until a neighbour has one.

*Bytes of one match.* A row of tokens is the encoding of its bytes if and only if each pair of
neighbours is the encoding of its own bytes. (Merges are taken by lowest rank; as long as no
merge crosses the border of two tokens, what happens on its sides doesn't depend on anything
outside, and the first merge that crossed it would be taken in the pair alone too.) So halves
are joined by encoding a window of the last tokens of one and the first of the other anew, and
growing it on either side until it begins and ends with the token it had there before: all
tokens outside are then stable.

Texts longer than ``SPAN`` bytes are cut into spans that may lie in different tasks; their
heads and tails are joined up a tree of ``FAN`` neighbours a level.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from heapq import heapify, heappop, heappush
from itertools import chain, groupby, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import small_batches
from headway.session import materialise

SPAN = 1 << 20
FAN_BITS = 4
LEAF_CHARS = 1 << 13
LEAF_BYTES = 8
FEW_BYTES = 256
NO_RANK = 1 << 62
KNOWN_PIECES = 1 << 19  # pieces whose ids a worker remembers, then it starts anew

CUT = r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=[^\s\p{L}\p{N}'])(?=[\s\p{L}\p{N}])"
FIRST_CUT, LAST_CUT = regex.compile(CUT), regex.compile(CUT, regex.REVERSE)

BLOCKS = "doc_id long, row long, place long, alone boolean, ids array<int>"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 token and rank a line."""
    with open(path, "rb") as file:
        return parse_ranks(file.read())


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}


def unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype=np.int32).tolist()


class Element:
    """A stretch of text: raw head and tail, or all of it raw when ``ids`` is None (ids are packed)."""

    __slots__ = ("head", "ids", "tail")

    def __init__(self, head: str, ids: bytes | None = None, tail: str = ""):
        self.head, self.ids, self.tail = head, ids, tail


class Encoder:
    """Encoding by one vocabulary and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.matches = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}  # packed ids
        self.windows: dict[bytes, list[int]] = {}
        self.borders: dict[tuple[int, int], list[int]] = {}  # encodings of two tokens' bytes

    # ---- bytes of one match

    def merged(self, data: bytes) -> list[int]:
        """Lowest-rank merges of a few bytes, one after the other."""
        known = self.windows.get(data)
        if known is not None:
            return known
        cuts = self._few(data) if len(data) <= FEW_BYTES else self._many(data)
        out = [self.ranks[data[a:b]] for a, b in pairwise(cuts)]
        if len(data) <= 2 * LEAF_BYTES:
            if len(self.windows) >= KNOWN_PIECES:
                self.windows.clear()
            self.windows[data] = out
        return out

    def _few(self, data: bytes) -> list[int]:
        """Borders of the merged parts; the ranks of all neighbours lie in one list."""
        rank = self.ranks.get
        cuts = list(range(len(data) + 1))
        ranks = [rank(data[k : k + 2], NO_RANK) for k in range(len(data) - 1)]
        while ranks:
            best = min(ranks)
            if best == NO_RANK:
                break
            at = ranks.index(best)
            del ranks[at], cuts[at + 1]
            if at:
                ranks[at - 1] = rank(data[cuts[at - 1] : cuts[at + 1]], NO_RANK)
            if at < len(ranks):
                ranks[at] = rank(data[cuts[at] : cuts[at + 2]], NO_RANK)
        return cuts

    def _many(self, data: bytes) -> list[int]:
        """The same with a heap of (rank, place) for long windows."""
        rank, n = self.ranks.get, len(data)
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := rank(data[k : k + 2])) is not None]
        heapify(heap)

        def offer(k: int) -> None:
            stop = after[after[k]]
            if (r := rank(data[k:stop])) is not None:
                heappush(heap, (r, k, stop))

        while heap:
            _, k, stop = heappop(heap)
            if before[k] is None or after[k] >= n or after[after[k]] != stop:
                continue  # one of the two parts is not there any more
            gone = after[k]
            after[k], before[gone] = stop, None
            if stop < n:
                before[stop] = k
                offer(k)
            if before[k] >= 0:
                offer(before[k])
        cuts = [0]
        while cuts[-1] < n:
            cuts.append(after[cuts[-1]])
        return cuts

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings behind each other."""
        if not left or not right:
            return left or right
        pair = left[-1], right[0]
        window = self.borders.get(pair)
        if window is None:
            window = self.merged(self.tokens[pair[0]] + self.tokens[pair[1]])
            if len(self.borders) >= KNOWN_PIECES:
                self.borders.clear()
            self.borders[pair] = window
        i = j = 1
        while True:
            more_left = i < len(left) and window[0] != left[-i]
            more_right = j < len(right) and window[-1] != right[j - 1]
            if not more_left and not more_right:
                return left[: len(left) - i] + window + right[j:]
            i = min(2 * i, len(left)) if more_left else i
            j = min(2 * j, len(right)) if more_right else j
            window = self.merged(b"".join([self.tokens[t] for t in left[-i:] + right[:j]]))

    def halves(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        middle = len(data) // 2
        return self.join_tokens(self.halves(data[:middle]), self.halves(data[middle:]))

    def piece(self, match: str) -> bytes:
        """The packed ids of one match: its own rank if it has one, else the reduction of its bytes."""
        data = match.encode()
        whole = self.ranks.get(data)
        ids = array("i", self.halves(data) if whole is None else [whole]).tobytes()
        if len(data) <= 64:
            if len(self.pieces) >= KNOWN_PIECES:
                self.pieces.clear()
            self.pieces[match] = ids
        return ids

    # ---- text

    def between(self, text: str) -> bytes:
        """The packed ids of text whose ends are cuts or ends of the whole."""
        known, piece = self.pieces.get, self.piece
        return b"".join([known(m) or piece(m) for m in self.matches(text)])

    def element(self, text: str) -> Element:
        if len(text) > LEAF_CHARS:
            middle = len(text) // 2
            return self.join(self.element(text[:middle]), self.element(text[middle:]), None)
        first = FIRST_CUT.search(text)
        if first is None:
            return Element(text)
        start, stop = first.start(), LAST_CUT.search(text).start()
        return Element(text[:start], self.between(text[start:stop]), text[stop:])

    def join(self, left: Element, right: Element, emit: Callable[[bytes], None] | None) -> Element:
        """The element of both texts. ``emit`` takes the ids that become known between them; without
        it the ids of both are kept together."""
        if not left.head and left.ids is None:
            return right
        if not right.head and right.ids is None:
            return left
        end = left.head if left.ids is None else left.tail
        cut = bool(end and right.head and FIRST_CUT.match(end[-1] + right.head[0], 1))
        if left.ids is None and right.ids is None:
            return Element(left.head, b"", right.head) if cut else Element(left.head + right.head)
        if left.ids is None:
            found = self.between(right.head) if cut else b""
            head, tail = left.head if cut else left.head + right.head, right.tail
        elif right.ids is None:
            found = self.between(left.tail) if cut else b""
            head, tail = left.head, right.head if cut else left.tail + right.head
        else:
            found = self.between(left.tail + right.head)
            head, tail = left.head, right.tail
        if emit is not None:
            emit(found)
            return Element(head, b"", tail)
        return Element(head, b"".join([left.ids or b"", found, right.ids or b""]), tail)

    def encode(self, text: str) -> bytes:
        whole = self.element(text)
        if whole.ids is None:
            return self.between(whole.head)
        return self.between(whole.head) + whole.ids + self.between(whole.tail)

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of a row of ids: halves are decoded and put together."""
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.tokens.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


@lru_cache(maxsize=2)
def _encoder(raw: bytes, pattern: str) -> Encoder:
    return Encoder(parse_ranks(raw), pattern)


class Shared:
    """A vocabulary (a file of some megabytes, whatever the data) as tasks get it."""

    def __init__(self, df: DataFrame, path: str, pattern: str):
        with open(path, "rb") as file:
            self.raw = df.sparkSession.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def __call__(self) -> Encoder:
        return _encoder(self.raw.value, self.pattern)


_BLOCKS = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("alone", pa.bool_()), ("ids", pa.list_(pa.int32()))]
)


def _lists(rows: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(rows), dtype=np.int32))


def _parts(batch: pa.RecordBatch, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``most`` bytes, so that long texts don't meet in one."""
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


@dataclass
class Blocks:
    """Encoded texts (doc_id, row, place, alone, ids): ``short`` ones are one block each, ``long`` ones
    several under one row, in the order of their place."""

    short: DataFrame
    long: DataFrame

    def all(self) -> DataFrame:
        return self.short.unionByName(self.long)


def encoded(docs: DataFrame, path: str, pattern: str, span: int = SPAN) -> Blocks:
    """The ids of every text in blocks; a text of more than ``span`` bytes is a long one.

    Null texts are empty and have no ids. Repeated and null ids are rows of their own. Special
    tokens are ordinary text.
    """
    small_batches(docs)
    shared = Shared(docs, path, pattern)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.alias("text")
    )

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared()
        for whole in batches:
            for batch in _parts(whole):
                ids = _lists([encoder.encode(t) for t in batch.column(2).to_pylist()])
                n = batch.num_rows
                columns = [batch.column(0), batch.column(1), pa.array(np.zeros(n, np.int64)), pa.array([True] * n), ids]
                yield pa.RecordBatch.from_arrays(columns, schema=_BLOCKS)

    fits = F.octet_length("text") <= span
    return Blocks(rows.filter(fits).mapInArrow(short, BLOCKS), _spanned(rows.filter(~fits), shared, span))


_EDGES = pa.schema(
    [("doc_id", pa.int64()), ("row", pa.int64()), ("place", pa.int64()), ("k", pa.int64()), ("first", pa.int64()),
     ("head", pa.string()), ("tail", pa.string()), ("raw", pa.bool_()), ("ids", pa.list_(pa.int32()))]
)
_EDGES_SQL = (
    "doc_id long, row long, place long, k long, first long, head string, tail string, raw boolean, ids array<int>"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _spanned(rows: DataFrame, shared: Shared, span: int) -> DataFrame:
    """Blocks of long texts. A row with ``k`` is the edge of a stretch, one without it holds ids."""
    spans = F.explode(F.expr(f"sequence(0L, (length(text) - 1) div {span})")).alias("k")
    cut = rows.select("doc_id", "row", spans, "text").select(
        "doc_id", "row", "k", F.expr(f"substring(text, CAST(k * {span} + 1 AS INT), {span})").alias("text")
    )

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared()
        for batch in batches:
            for doc_id, row, k, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = encoder.element(text)
                raw = found.ids is None
                out = [(doc_id, row, None, k, k, found.head, found.tail, raw, None)]
                if not raw:
                    out.append((doc_id, row, 2 * k + 1, None, None, None, None, None, unpacked(found.ids)))
                yield _batch(out, _EDGES)

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared()
        stretches = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for (row, k), group in groupby(stretches, key=lambda r: (r[1], r[3])):
            whole, out, start, last, doc_id = None, [], 0, False, None
            for doc_id, _, first, _, head, tail, raw, last in group:
                right = Element(head, None if raw else b"", tail)
                if whole is None:
                    whole, start = right, first
                    continue
                whole = encoder.join(
                    whole, right, lambda ids, at=2 * first: out.append((doc_id, row, at, *(None,) * 5, unpacked(ids)))
                )
            if last:  # one stretch is left of the text: its ends are those of the text
                ends = [(-1, whole.head)] if whole.ids is None else [(-1, whole.head), (1 << 62, whole.tail)]
                out += [(doc_id, row, at, *(None,) * 5, unpacked(encoder.between(text))) for at, text in ends]
            else:
                out.append((doc_id, row, None, k, start, whole.head, whole.tail, whole.ids is None, None))
            yield _batch(out, _EDGES)

    now = materialise(cut.mapInArrow(elements, _EDGES_SQL), "bpe-spans")
    tables = [now]
    most = now.agg(F.max("k")).first()[0]
    while most is not None:
        # of a shorter text one stretch is left sooner; it goes up as it is
        stretches = now.filter("k is not null").select(
            "doc_id", "row", "first", F.shiftright("k", FAN_BITS).alias("k"), "head", "tail", "raw",
            F.lit(most >> FAN_BITS == 0).alias("last"),
        )
        order = stretches.repartition("row", "k").sortWithinPartitions("row", "k", "first")
        now = materialise(order.mapInArrow(level, _EDGES_SQL), "bpe-level")
        tables.append(now)
        most = most >> FAN_BITS if most >> FAN_BITS else None
    found = reduce(DataFrame.unionByName, tables).filter("place is not null")
    return found.select("doc_id", "row", "place", F.lit(False).alias("alone"), "ids")


def _ids_of(batch: pa.RecordBatch) -> Iterator[list[int]]:
    """The lists of the last column, by way of one flat list."""
    lists = batch.column(batch.num_columns - 1)
    offsets = lists.offsets.to_pylist()
    flat = lists.values[offsets[0] : offsets[-1]].to_numpy().tolist()
    return (flat[a - offsets[0] : b - offsets[0]] for a, b in pairwise(offsets))


def decoded(blocks: DataFrame, path: str, pattern: str) -> DataFrame:
    """The bytes of every block beside its keys: doc_id, row, place, alone, bytes."""
    shared = Shared(blocks, path, pattern)
    schema = pa.schema([*list(_BLOCKS)[:4], pa.field("bytes", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared()
        for whole in batches:
            for batch in _parts(whole):
                data = pa.array([encoder.decode(ids) for ids in _ids_of(batch)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], data], schema=schema)

    names = [f.name for f in _BLOCKS]
    return blocks.select(names).mapInArrow(work, "doc_id long, row long, place long, alone boolean, bytes binary")


_DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def digests(blocks: Blocks, path: str, pattern: str) -> DataFrame:
    """A row per text: doc_id, number of ids, SHA-256 of the ids joined by blanks and of the decoded bytes.

    The blocks of a long text meet in one task and pass through it one after the other.
    """
    shared = Shared(blocks.short, path, pattern)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared()
        words = [str(k) for k in range(len(encoder.tokens))]

        def rows():
            for whole in batches:
                for batch in _parts(whole):
                    yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _ids_of(batch), strict=True)

        out = []
        for _, group in groupby(rows(), key=lambda r: r[1]):
            n, listed, data, doc_id = 0, hashlib.sha256(), hashlib.sha256(), None
            for doc_id, _, ids in group:
                if ids:
                    listed.update(((" " if n else "") + " ".join(map(words.__getitem__, ids))).encode())
                    data.update(encoder.decode(ids))
                    n += len(ids)
            out.append((doc_id, n, listed.hexdigest(), data.hexdigest()))
            if len(out) == 2000:
                yield _batch(out, _DIGESTS)
                out = []
        if out:
            yield _batch(out, _DIGESTS)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names = [f.name for f in _BLOCKS]
    long = blocks.long.select(names).repartition("row").sortWithinPartitions("row", "place")
    return blocks.short.select(names).mapInArrow(work, schema).unionByName(long.mapInArrow(work, schema))

