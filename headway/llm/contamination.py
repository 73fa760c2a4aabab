"""Benchmark decontamination by winnowing.

Of the hashes of all k-word grams in a sliding window the smallest is kept (the last one
of equal hashes). A span of ``window`` shared words covers one full window of grams, so
both sides keep a common fingerprint in it: none is missed. The fingerprints of the
documents are joined to those of the benchmark and every hit is extended, word by word, to
the longest shared span. Items shorter than ``window`` words are met by grams of their own
length, all of which are kept.

The benchmark's fingerprints are the build side of the join. They are taken in blocks of a
bounded number of words; a larger benchmark means more passes over the documents, not a
larger block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import document_keys, small_batches
from headway.session import materialise

GRAM = 5
BLOCK_WORDS = 500_000

# ASCII other than digits and letters separates words; upper-case ASCII letters become lower case.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else (b if b >= 128 or chr(b).isalnum() else 32) for b in range(256)
)
REPORT = "struct<n_words:long,spans:array<struct<start:long,stop:long,item:long>>>"
_REPORT_TYPE = pa.struct(
    [("n_words", pa.int64()),
     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("item", pa.int64())])))]
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def gram_hashes(ids: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` word hashes."""
    count = max(0, len(ids) - gram + 1)
    out = np.zeros(count, np.uint64)
    for k in range(gram):
        out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ ids[k : k + count]
        out ^= out >> np.uint64(29)
    return out


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the smallest hash of each window; of equal ones the last."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, width)
    last = width - 1 - np.argmin(view[:, ::-1], axis=1)
    return np.unique(last + np.arange(len(view)))


class Benchmark:
    """Fingerprints of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str | None]], window: int, gram: int = GRAM):
        gram = min(gram, window)
        self.window, self.gram = window, gram
        self.items = [(item, w) for item, text in items if (w := words(text))]
        vocabulary = {w for _, line in self.items for w in line}
        self.ids = {w: xxhash.xxh64_intdigest(w) | 1 for w in vocabulary}
        self.prints: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for at, (_, line) in enumerate(self.items):
            size, width = (gram, window - gram + 1) if len(line) >= window else (len(line), 1)
            hashes = gram_hashes(self._hash(line), size)
            table = self.prints.setdefault(size if width == 1 else 0, {})
            for position in winnow(hashes, width):
                table.setdefault(int(hashes[position]), []).append((at, int(position)))
        self.sorted = {k: np.array(sorted(t), np.uint64) for k, t in self.prints.items()}

    def _hash(self, line: list[bytes]) -> np.ndarray:
        """Word hashes; words the benchmark lacks are 0 and can be part of no hit."""
        get = self.ids.get
        return np.array([get(w, 0) for w in line], dtype=np.uint64)

    def spans(self, line: list[bytes]) -> list[tuple[int, int, int]]:
        """(start, stop, item): maximal shared word spans of at least ``window`` words or a whole short item."""
        ids = self._hash(line)
        found = []
        for kind, table in self.prints.items():
            size = kind or self.gram
            width = 1 if kind else self.window - self.gram + 1
            hashes = gram_hashes(ids, size)
            kept = winnow(hashes, width)
            keys = self.sorted[kind]
            spot = np.minimum(np.searchsorted(keys, hashes[kept]), len(keys) - 1)
            done: dict[tuple[int, int], int] = {}
            for position in kept[keys[spot] == hashes[kept]].tolist():
                for at, where in table[int(hashes[position])]:
                    if done.get((at, position - where), -1) > position:
                        continue
                    item, other = self.items[at]
                    lo, hi = position, position
                    shift = where - position
                    while lo > 0 and lo + shift > 0 and line[lo - 1] == other[lo - 1 + shift]:
                        lo -= 1
                    while hi < len(line) and hi + shift < len(other) and line[hi] == other[hi + shift]:
                        hi += 1
                    done[at, position - where] = hi
                    if hi - lo >= min(self.window, len(other)):
                        found.append((lo, hi, item))
        return found


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str | None]]]:
    """The items in lists of at most ``block_words`` words, unless one item alone has more."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        n = len(words(row[1]))
        if held and size + n > block_words:
            yield held
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    yield held


def scan(text: Column, index: Benchmark) -> Column:
    """Struct of ``n_words`` and ``spans`` for a text column."""

    @F.arrow_udf(REPORT)
    def report(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            line = words(text)
            spans = [{"start": a, "stop": b, "item": i} for a, b, i in index.spans(line)]
            out.append({"n_words": len(line), "spans": spans})
        return pa.array(out, _REPORT_TYPE)

    return report(text)


def _covered(spans: Column) -> Column:
    """Number of words in the union of spans."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, s):
        fresh = F.greatest(s["stop"] - F.greatest(s["start"], acc["end"]), F.lit(0))
        return F.struct(
            F.greatest(acc["end"], s["stop"]).cast("long").alias("end"),
            (acc["n"] + fresh).cast("long").alias("n"),
        )

    return F.aggregate(F.array_sort(spans), start, add, lambda acc: acc["n"])


def _summary(found: DataFrame) -> DataFrame:
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item"].cast("string"))))
    hit = _covered(F.col("spans"))
    return found.select(
        "doc_id", "h", "n_words", hit.alias("n_hit"), items.alias("items"),
        F.transform("spans", lambda s: F.struct(s["start"], s["stop"], s["item"])).alias("spans"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row per document: doc_id, h, n_words, n_hit, items, spans, contaminated.

    A word is hit if it lies in an occurrence of ``window`` consecutive item words, or of a
    whole shorter item. Null and empty texts have no words and are clean; items without
    words match nothing; equal items are reported each. One pass over the documents per block.
    """
    lists = blocks(benchmark, block_words)
    text = F.col("text").cast("string")
    first = scan(text, Benchmark(next(lists), window))
    found = document_keys(docs, first.alias("r")).select("doc_id", "h", "r.n_words", "r.spans")
    for items in lists:
        more = document_keys(docs, scan(text, Benchmark(items, window)).alias("r"))
        more = more.filter(F.size("r.spans") > 0).groupBy("doc_id", "h").agg(F.first("r.spans").alias("more"))
        more = materialise(more, "contamination")
        base = found.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "n_words", "spans")
        same = base["_id"].eqNullSafe(more["doc_id"]) & (base["_h"] == more["h"])
        both = F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.concat("spans", "more"))
        found = base.join(more, same, "left").select(
            F.col("_id").alias("doc_id"), F.col("_h").alias("h"), "n_words", both.alias("spans")
        )
    return _summary(found)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The documents that share no window with the benchmark; only a filter, no join."""
    small_batches(docs)
    clean = docs
    for items in blocks(benchmark, block_words):
        spans = scan(F.col("text").cast("string"), Benchmark(items, window))["spans"]
        clean = clean.filter(F.size(spans) == 0)
    return clean
