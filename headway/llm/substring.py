"""Removal of repeated passages by sliding sentence spans.

A text is cut into sentences at end marks, clause marks and line ends, and long stretches
without marks behind the word with the smallest hash of every window of ``WINDOW`` words:
no piece of them has more words, and equal stretches are cut alike but for a window at either
end. In scripts without spaces two characters count as a word, and cuts lie between any. From every sentence
the shortest run of at least ``SENTENCES`` sentences and ``WORDS`` words is hashed; the
hashes are joined over the whole corpus. The first occurrence of a run, by doc_id and
place, stays; the sentences under any other occurrence are removed. A passage that two
documents share is found wherever it holds one such run, whatever stands around it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import document_keys, packed, runtime_filters, spread_join
from headway.session import materialise, small_table

SENTENCES = 3
WORDS = 20
# Letters of scripts that are written without spaces: Thai, Lao, Burmese, Khmer, kana, ideographs.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
# A sentence with its marks and the white space behind it; the pieces of a text add up to it.
SENTENCE = re.compile(
    r"[^.!?;:,\n。！？；：，、]*(?:[.!?;:,]+(?=\s|$)\s*|[。！？；：，、]+\s*|\n\s*|[.!?;:,]+|$)"
)
UNIT = re.compile(rf"([{UNSPACED}]|[^\s{UNSPACED}]+)\s*")
WORD = re.compile(r"(\S+)\s*")
LETTER = re.compile(f"[{UNSPACED}]")
LONG = 16  # words from which a sentence is cut further
WINDOW = 8


def _halves(piece: str) -> int:
    """Length of a piece in half words: words count two, letters of scripts without spaces one."""
    if _spaced(piece):
        return 2 * len(piece.split())
    return sum(1 if LETTER.match(u) else 2 for u in UNIT.findall(piece))


def _spaced(text: str) -> bool:
    """Whether a text has no letters of scripts without spaces."""
    return text.isascii() or not LETTER.search(text)


def sentences(text: str | None) -> list[str]:
    """Consecutive pieces of the text, none empty; pieces joined are the text."""
    out = []
    spaced = _spaced(text or "")
    for piece in SENTENCE.findall(text or ""):
        plain = spaced or _spaced(piece)
        if piece.count(" ") >= LONG or not plain and _halves(piece) > 2 * LONG:
            out.extend(_cut(piece, WORD if plain else UNIT))
        elif piece:
            out.append(piece)
    return out


def _cut(sentence: str, unit: re.Pattern) -> Iterator[str]:
    """A long sentence in parts of ``WINDOW`` words at most, which end behind the smallest hash of a window.

    Of equal hashes the last one counts, so that a word said over and over is cut behind each.
    """
    matches = list(unit.finditer(sentence))
    hashes = [zlib.crc32(m[1].encode("utf-8", "surrogatepass")) for m in matches]
    start, smallest, at = 0, 0, -1
    for stop in range(WINDOW, len(hashes) + 1):
        before = at
        if at < stop - WINDOW:
            window = hashes[stop - WINDOW : stop]
            smallest = min(window)
            at = stop - 1 - window[::-1].index(smallest)
        elif hashes[stop - 1] <= smallest:
            at, smallest = stop - 1, hashes[stop - 1]
        if at != before:
            end = matches[at].end()
            yield sentence[start:end]
            start = end
    if start < len(sentence):
        yield sentence[start:]


def runs(text: str | None, least: int = SENTENCES, least_words: int = WORDS) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, number of sentences, hash) of every run; white space does not count.

    A text of fewer sentences or words has none.
    """
    pieces = sentences(text)
    parts = [s.encode("utf-8", "surrogatepass").split() for s in pieces]
    lines = [b" ".join(p) for p in parts]
    lengths = [2 * len(p) for p in parts] if _spaced(text or "") else [_halves(s) for s in pieces]
    stop, held, least_words = 0, 0, 2 * least_words
    for at in range(len(pieces)):
        while stop < len(pieces) and (held < least_words or stop - at < least):
            held += lengths[stop]
            stop += 1
        if held < least_words or stop - at < least:
            return
        if lengths[at]:
            yield at, stop - at, xxhash.xxh3_128_digest(b" ".join(x for x in lines[at:stop] if x))
        held -= lengths[at]


def _spans(docs: DataFrame, least: int, least_words: int) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs, texts = (c.to_pylist() for c in batch.columns)
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, h, text in zip(ids, hs, texts, strict=True):
                for at, n, span in runs(text, least, least_words):
                    for column, value in zip(rows, (span, doc_id, h, at, n), strict=True):
                        column.append(value)
                if len(rows[0]) > 50_000:
                    yield _record(rows)
                    rows = ([], [], [], [], [])
            yield _record(rows)

    keys = document_keys(docs, F.col("text").cast("string").alias("text"))
    return keys.mapInArrow(hashed, "span long, rest long, doc_id long, h long, at int, n int")


def _record(rows: tuple[list, ...]) -> pa.RecordBatch:
    spans = np.frombuffer(b"".join(rows[0]), "<i8").reshape(-1, 2)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(spans[:, 0]), pa.array(spans[:, 1]), *map(pa.array, rows[1:], kinds)],
        names=["span", "rest", "doc_id", "h", "at", "n"],
    )


def repeats(docs: DataFrame, least: int = SENTENCES, least_words: int = WORDS) -> DataFrame:
    """(doc_id, h, at, n, first_id): every occurrence of a run that is not its first one.

    Null ids come after all others. Rows equal in id and text are one occurrence.
    """
    spans = materialise(_spans(docs, least, least_words), "sentence-runs")
    # Half of the hash finds what may be repeated, all of it decides.
    often = materialise(
        spans.groupBy("span").agg(F.count("*").alias("rows")).filter("rows > 1"), "repeated-halves"
    )
    with runtime_filters(docs.sparkSession):
        shared = materialise(spread_join(spans, often, "span", "rows").drop("rows"), "repeated-runs")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "at")
    key = F.struct("span", "rest").alias("run")
    firsts = shared.groupBy(key).agg(F.min(place).alias("first"), F.count("*").alias("rows"))
    firsts = materialise(firsts.filter("rows > 1"), "first-runs")
    found = spread_join(shared.withColumn("run", key), firsts, "run", "rows")
    is_first = (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("h") == F.col("first.h"))
        & (F.col("at") == F.col("first.at"))
    )
    return found.filter(~is_first).select("doc_id", "h", "at", "n", F.col("first.doc_id").alias("first_id"))


def disjoint(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (at, stop) as few disjoint ones, in one pass over the sorted runs."""
    out = []
    for at, stop in sorted(runs):
        if out and at <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([at, stop])
    return [(at, stop) for at, stop in out]


def _merged(runs: str) -> Column:
    @F.arrow_udf("array<struct<at:int,stop:int>>")
    def merged(lists: pa.Array) -> pa.Array:
        rows = [disjoint([(r["at"], r["stop"]) for r in row]) for row in lists.to_pylist()]
        kind = pa.list_(pa.struct([("at", pa.int32()), ("stop", pa.int32())]))
        return pa.array([[{"at": a, "stop": b} for a, b in row] for row in rows], kind)

    return merged(runs)


def without_repeats(docs: DataFrame, least: int = SENTENCES, least_words: int = WORDS) -> DataFrame:
    """The documents with further columns clean_text, n_sentences, n_removed, first_ids.

    ``clean_text`` lacks the sentences under repeated runs (null stays null), ``first_ids``
    lists the documents that keep them. Columns of these names are replaced.
    """
    found = repeats(docs, least, least_words)
    per_doc = found.groupBy("doc_id", "h").agg(
        F.collect_set(F.struct("at", (F.col("at") + F.col("n")).alias("stop"))).alias("runs"),
        F.array_sort(F.collect_set("first_id")).alias("first_ids"),
    )
    docs = docs.drop("clean_text", "n_sentences", "n_removed", "first_ids")
    per_doc = materialise(per_doc.withColumn("runs", _merged("runs")), "runs-of-documents")
    local = small_table(per_doc)
    other = per_doc.hint("shuffle_hash") if local is None else F.broadcast(local)
    rows = packed(docs)
    same = rows["_id"].eqNullSafe(other["doc_id"]) & (rows["_h"] == other["h"])
    joined = rows.join(other, same, "left")

    @F.arrow_udf("struct<clean_text:string,n_sentences:long,n_removed:long>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, runs_of in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            parts = sentences(text)
            gone = {k for r in runs_of or () for k in range(r["at"], r["stop"])}
            left = "".join(p for k, p in enumerate(parts) if k not in gone)
            out.append((None if text is None else left, len(parts), len(gone)))
        kinds = (pa.string(), pa.int64(), pa.int64())
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else ((), (), ()), kinds, strict=True)]
        return pa.StructArray.from_arrays(columns, names=["clean_text", "n_sentences", "n_removed"])

    done = joined.withColumn("cut", cut(F.col("row.text").cast("string"), "runs"))
    firsts = F.coalesce("first_ids", F.expr("cast(array() as array<bigint>)")).alias("first_ids")
    return done.select("row.*", "cut.*", firsts)
