"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model.

The model counts character trigrams of trusted texts. Highest-order probabilities use
counts, lower orders the number of distinct continuations; every order has three
discounts. Trigrams are packed into one long, 21 bits per character.

Scoring is a sharded count join. Documents are taken in blocks; a block lists, for each of
its trigrams, the documents that hold it and how often. These lists, packed per shard, and
the trigram probabilities are dealt over the same shards, where each list is multiplied by
its log probability; the partial sums of a block then meet by block. A task holds one
shard of the model and the lists of one block at a time, whatever the size of the corpus.

No n-gram model tells one word repeated over and over from prose by its mean: each repeat
costs the same as a word of prose may. The number of distinct trigrams of a text does tell
it, and the blocks count them anyway; it is held against the trusted texts as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headway.llm.common import KEY_ROWS, document_keys, without
from headway.session import lookup_join, materialise, small_table

CHAR_BITS = 21
BEGIN, END = 0x1FFFFE, 0x1FFFFD
PIECE = 4_000_000  # characters handled at once, and about the size of a block
BLOCK_DOCS = 50_000
SHARDS = 16
SHARD_PRIME = 1_000_003
BUCKET_BLOCKS = 32
LOW, HIGH = 0.005, 0.99  # chosen from recall on labelled texts, see README
VARIED = 0.002  # quantile of the trusted texts below which a text has too few distinct trigrams
LEAST_TRUSTED = 1
STRETCH = 3.0  # deviations that the limits of a single trusted document lie away from it
DIGITS = 4


def _symbols(text: str) -> np.ndarray:
    """Code points of the text with white-space runs as one space, digits as 0, and end marks."""
    line = " ".join(text.split()).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(line, np.uint32).astype(np.int64)
    codes[(codes >= 48) & (codes <= 57)] = 48
    return np.concatenate(([BEGIN, BEGIN], codes, [END]))


def _grams(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct trigrams and their counts, piece by piece."""
    for at in range(0, len(symbols) - 2, PIECE):
        part = symbols[at : at + PIECE + 2]
        keys = (part[:-2] << 2 * CHAR_BITS) | (part[1:-1] << CHAR_BITS) | part[2:]
        yield np.unique(keys, return_counts=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial trigram counts of the texts in column 0."""
    held, size = [], 0

    def sums() -> pa.RecordBatch:
        keys = np.concatenate([k for k, _ in held])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in held])[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[first]), pa.array(np.add.reduceat(counts, first))], names=["g", "c"]
        )

    for batch in batches:
        for text in batch.column(0).to_pylist():
            for keys, counts in _grams(_symbols(text)):
                held.append((keys, counts))
                size += len(keys)
            if size > PIECE:
                yield sums()
                held, size = [], 0
    if held:
        yield sums()


def _part(column: str, shift: int, bits: int) -> Column:
    return F.shiftright(column, shift).bitwiseAND(F.lit((1 << bits) - 1))


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    """D1, D2, D3+ from the numbers of n-grams seen one to four times."""
    row = table.agg(*[F.sum((F.col("c") == k).cast("long")) for k in range(1, 5)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in row)
    if not n1 or not n2:
        return 0.5, 0.75, 1.0
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))  # type: ignore[return-value]


def _discount(d: tuple[float, float, float]) -> Column:
    return F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])


def _contexts(table: DataFrame, context: Column, d: tuple[float, float, float], name: str) -> DataFrame:
    """Per context the sum of counts and the weight left for the lower order."""
    left = F.sum(_discount(d)) / F.sum("c")
    return table.groupBy(context.alias(name)).agg(
        F.sum("c").cast("double").alias(f"total_{name}"), left.alias(f"weight_{name}")
    )


def _seen(c: str, d: tuple[float, float, float], total: str) -> Column:
    """The discounted share of a count; 0 if it is null."""
    cut = F.when(F.col(c) == 1, d[0]).when(F.col(c) == 2, d[1]).otherwise(d[2])
    return F.coalesce((F.col(c) - cut) / F.col(total), F.lit(0.0))


def log_probabilities(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(g, logp): log probability of the last character of each trigram in ``grams`` (g).

    ``counts`` (g, c) are those of the trusted texts. Contexts never seen leave their whole
    weight to the next lower order, characters never seen share the uniform order.
    """
    three = counts.withColumn("c", F.col("c").cast("long"))
    two = materialise(
        three.groupBy(_part("g", 0, 2 * CHAR_BITS).alias("g")).agg(F.count("*").alias("c")), "bigrams"
    )
    one = materialise(two.groupBy(_part("g", 0, CHAR_BITS).alias("g")).agg(F.count("*").alias("c")), "unigrams")
    d3, d2, d1 = _discounts(three), _discounts(two), _discounts(one)
    total, kinds, left = one.agg(
        F.sum("c"), F.count("*"), F.sum(_discount(d1))
    ).first()
    total, kinds, left = float(total or 1), int(kinds), float(left or 1)
    uniform = (left / total) / (kinds + 1)
    # There are at most as many characters as code points, so these two have a fixed bound.
    chars = F.broadcast(one.select(F.col("g").alias("last"), F.col("c").alias("c1")))
    middles = F.broadcast(_contexts(two, _part("g", CHAR_BITS, CHAR_BITS), d2, "mid"))
    pairs = two.select(F.col("g").alias("pair"), F.col("c").alias("c2"))
    fronts = _contexts(three, F.shiftright("g", CHAR_BITS), d3, "front")
    p1 = _seen("c1", d1, "total1") + F.lit(uniform)
    p2 = F.when(F.col("total_mid").isNull(), F.col("p1")).otherwise(
        _seen("c2", d2, "total_mid") + F.col("weight_mid") * F.col("p1")
    )
    p3 = F.when(F.col("total_front").isNull(), F.col("p2")).otherwise(
        _seen("c", d3, "total_front") + F.col("weight_front") * F.col("p2")
    )
    wanted = grams.select(
        "g",
        F.shiftright("g", CHAR_BITS).alias("front"),
        _part("g", 0, 2 * CHAR_BITS).alias("pair"),
        _part("g", CHAR_BITS, CHAR_BITS).alias("mid"),
        _part("g", 0, CHAR_BITS).alias("last"),
    )
    return (
        wanted.join(three, "g", "left")
        .join(fronts, "front", "left")
        .join(pairs, "pair", "left")
        .join(middles, "mid", "left")
        .join(chars, "last", "left")
        .withColumn("total1", F.lit(total))
        .withColumn("p1", p1)
        .withColumn("p2", p2)
        .select("g", F.log(p3).alias("logp"))
    )


BLOCKS = "block long, shard int, lists binary, ids array<long>, hs array<long>, langs array<string>, lengths array<long>, "
BLOCKS += "kinds array<long>"
_BLOCKS = pa.schema(
    [("block", pa.int64()), ("shard", pa.int32()), ("lists", pa.binary()), ("ids", pa.list_(pa.int64())),
     ("hs", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())), ("lengths", pa.list_(pa.int64())),
     ("kinds", pa.list_(pa.int64()))]
)


def _pack(keys: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> bytes:
    """Lists of documents and counts per trigram, sorted by trigram, as compressed columns.

    Trigrams and, within a trigram, documents are written as steps.
    """
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(first, len(keys)))
    steps = np.diff(docs, prepend=0)
    steps[first] = docs[first]
    columns = [np.diff(keys[first], prepend=0), sizes, steps.astype("<u2"), counts.astype("<u4")]
    # Bytes of equal weight lie together, which leaves long runs of zeros.
    planes = [c.view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns]
    head = np.array([len(first), len(keys)], "<i8").tobytes()
    return zstandard.ZstdCompressor(3).compress(head + b"".join(planes))


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams, the lengths of their lists, and the documents and counts of all lists."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    grams, rows = np.frombuffer(raw, "<i8", 2)
    at, out = 16, []
    for n, kind in ((grams, "<i8"), (grams, "<i8"), (rows, "<u2"), (rows, "<u4")):
        width = int(n) * np.dtype(kind).itemsize
        plane = np.frombuffer(raw, np.uint8, width, at).reshape(-1, int(n)).T
        out.append(np.ascontiguousarray(plane).view(kind).ravel())
        at += width
    keys, sizes, steps, counts = out
    docs = np.cumsum(steps.astype(np.int64))
    starts = np.cumsum(sizes) - sizes
    docs -= np.repeat(docs[starts] - steps[starts], sizes)
    return np.cumsum(keys), sizes, docs, counts


def _shard_of(keys: np.ndarray) -> np.ndarray:
    return keys % SHARD_PRIME % SHARDS


class _Block:
    """Documents of a block and their trigrams."""

    def __init__(self, number: int):
        self.number, self.size = number, 0
        self.rows: tuple[list, ...] = ([], [], [], [], [])
        self.grams: list[tuple[np.ndarray, np.ndarray, int]] = []

    def add(self, doc_id: int | None, h: int, lang: str | None, text: str | None) -> None:
        symbols = _symbols(text or "")
        length = len(symbols) - 2
        at = len(self.rows[0])
        parts = list(_grams(symbols))
        for keys, counts in parts:
            self.grams.append((keys, counts, at))
        kinds = len(parts[0][0] if len(parts) == 1 else np.unique(np.concatenate([k for k, _ in parts])))
        for column, value in zip(self.rows, (doc_id, h, lang, length, kinds), strict=True):
            column.append(value)
        self.size += length

    def records(self) -> Iterator[pa.RecordBatch]:
        """One row of the documents, then one of trigram lists per shard."""
        data = [[self.number], [None], [None], *[[column] for column in self.rows]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(data, _BLOCKS, strict=True)], schema=_BLOCKS
        )
        keys = np.concatenate([k for k, _, _ in self.grams])
        counts = np.concatenate([c for _, c, _ in self.grams])
        docs = np.repeat([d for _, _, d in self.grams], [len(k) for k, _, _ in self.grams])
        order = np.argsort(keys, kind="stable")
        keys, counts, docs = keys[order], counts[order], docs[order]
        shards = _shard_of(keys)
        found = [(s, shards == s) for s in np.unique(shards)]
        columns = [
            [self.number] * len(found),
            [int(s) for s, _ in found],
            [_pack(keys[mine], docs[mine], counts[mine]) for _, mine in found],
        ]
        columns += [[None] * len(found)] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _BLOCKS, strict=True)], schema=_BLOCKS
        )


def _blocks(docs: DataFrame) -> DataFrame:
    """The corpus as blocks of trigram lists, written once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            for first, doc_id, h, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block is None:
                    block = _Block(first)
                block.add(doc_id, h, lang, text)
                if block.size >= PIECE or len(block.rows[0]) >= BLOCK_DOCS:
                    yield from block.records()
                    block = None
        if block is not None:
            yield from block.records()

    rows = document_keys(
        docs, F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    # A block has the number of its first row.
    rows = rows.select(F.monotonically_increasing_id().alias("first"), "doc_id", "h", "lang", "text")
    return materialise(rows.mapInArrow(work, BLOCKS), "trigram-blocks")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trigrams of the lists in column 0."""
    for batch in batches:
        for data in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(_unpack(data)[0])], names=["g"])


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join trigram lists to log probabilities; rows come sorted by shard and bucket, model first."""
    now, held = None, []
    table: tuple[np.ndarray, np.ndarray] | None = None
    for batch in batches:
        shard, bucket, block, g, logp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        lists = batch.column(5)
        change = (shard[1:] != shard[:-1]) | (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])
        cuts = np.flatnonzero(change) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(shard)], strict=True):
            if hi <= lo:
                continue
            if (key := (int(shard[lo]), int(bucket[lo]))) != now:
                now, held, table = key, [], None
            if block[lo] < 0:
                held.append((g[lo:hi].copy(), logp[lo:hi].copy()))
                continue
            if table is None:
                keys = np.concatenate([k for k, _ in held])
                order = np.argsort(keys)
                table = keys[order], np.concatenate([p for _, p in held])[order]
            for row in range(lo, hi):
                grams, sizes, docs, counts = _unpack(lists[row].as_py())
                value = table[1][np.searchsorted(table[0], grams)]
                sums = np.bincount(docs, weights=np.repeat(value, sizes) * counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block[row]]), pa.array([key[0]], pa.int32()), pa.array([sums.tobytes()], pa.binary())],
                    names=["block", "shard", "sums"],
                )


def _gathered(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
    """Add up the partial sums of a block, in the order of the shards, beside its documents."""
    rows = parts.to_pylist()
    meta = next(r for r in rows if r["ids"] is not None)
    total = np.zeros(len(meta["ids"]))
    for r in sorted((r for r in rows if r["ids"] is None), key=lambda r: r["shard"]):
        values = np.frombuffer(r["sums"], np.float64)
        total[: len(values)] += values
    return pa.table(
        {
            "doc_id": pa.array(meta["ids"], pa.int64()),
            "h": pa.array(meta["hs"], pa.int64()),
            "lang": pa.array(meta["langs"], pa.string()),
            "length": pa.array(meta["lengths"], pa.int64()),
            "kinds": pa.array(meta["kinds"], pa.int64()),
            "logp": pa.array(total, pa.float64()),
        }
    )


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(doc_id, h, lang, length, kinds, score): mean negative log probability per character, written once.

    ``score`` is the log of the perplexity, null for texts without characters; ``kinds`` the
    number of distinct trigrams.
    """
    held = small_table(trusted, KEY_ROWS)
    known = trusted if held is None else F.broadcast(held)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text = text.filter("text IS NOT NULL").join(known, "doc_id", "left_semi").select("text")
    counts = text.mapInArrow(_counted, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))
    counts = materialise(counts, "trigram-counts")
    blocks = _blocks(docs)
    lists = blocks.filter("shard IS NOT NULL")
    grams = lists.select("lists").mapInArrow(_listed, "g long").distinct()
    model = materialise(log_probabilities(grams, counts), "trigram-model")
    number = blocks.filter("shard IS NULL").count()
    buckets = max(1, -(-number // BUCKET_BLOCKS))
    bucket = F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("int").alias("bucket")
    left = lists.select(
        "shard", bucket, "block", F.lit(0).cast("long").alias("g"), F.lit(0.0).alias("logp"), "lists"
    )
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    right = model.select(
        F.expr(f"cast(g % {SHARD_PRIME} % {SHARDS} as int)").alias("shard"), every,
        F.lit(-1).cast("long").alias("block"), "g", "logp", F.lit(None).cast("binary").alias("lists"),
    )
    dealt = left.unionByName(right).repartition(SHARDS * buckets, "shard", "bucket")
    # Blocks are numbered from 0 up, so that the model, at -1, comes first.
    dealt = dealt.sortWithinPartitions("shard", "bucket", "block")
    sums = dealt.mapInArrow(_partial_sums, "block long, shard int, sums binary")
    meta = blocks.filter("shard IS NULL").select("block", "ids", "hs", "langs", "lengths", "kinds")
    both = sums.unionByName(meta, allowMissingColumns=True)
    schema = "doc_id long, h long, lang string, length long, kinds long, logp double"
    found = both.groupBy("block").applyInArrow(_gathered, schema)
    # The end mark is predicted too; a text without characters has nothing else.
    score = F.when(F.col("length") > 1, F.round(-F.col("logp") / F.col("length"), DIGITS))
    return materialise(found.select("doc_id", "h", "lang", "length", "kinds", score.alias("score")), "perplexities")


def _variety() -> tuple[Column, Column]:
    """Distinct trigrams on two scales: of clean texts one falls with the length, the other rises."""
    kinds, length = F.col("kinds").cast("double"), F.col("length").cast("double")
    return F.round(F.log(kinds + 1) / F.log(length + 1), DIGITS), F.round(kinds / F.sqrt(length), 2)


def _quantiles(scores: DataFrame, by: list[str], low: float, high: float) -> DataFrame:
    """Exact quantiles of the rounded scores from counts per value."""
    counts = scores.groupBy(*by, "score").agg(F.count("*").alias("n"))
    up = Window.partitionBy(*by).orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(*by)
    ranked = counts.withColumns({"below": F.sum("n").over(up), "all": F.sum("n").over(every)})
    return ranked.groupBy(*by).agg(
        F.min(F.when(F.col("below") >= F.col("all") * low, F.col("score"))).alias("low"),
        F.min(F.when(F.col("below") >= F.col("all") * high, F.col("score"))).alias("high"),
        F.max("all").alias("trusted"),
    )


def _limits(known: DataFrame, by: list[str], low: float, high: float) -> DataFrame:
    """Limits of the score and of the two scales of variety, one row per group.

    Of few documents the quantiles are the range. It is widened by a share of the deviation
    that falls with their number, since their range is narrower than that of the language.
    """
    out = _quantiles(known, by, low, high)
    # The deviation within languages, rounded so that the order of summation does not show.
    each = known.groupBy(*by).agg((F.var_pop("score") * F.count("*")).alias("squares"), F.count("*").alias("n"))
    spread = F.sqrt(F.sum("squares") / F.greatest(F.sum("n") - F.count("*"), F.lit(1)))
    deviation = each.agg(F.round(spread, DIGITS)).first()[0] or 0.0
    further = F.lit(STRETCH * deviation) / F.col("trusted")
    out = out.withColumns(
        {
            "low": F.col("low") - F.when(F.col("trusted") * low < 1, further).otherwise(0.0),
            "high": F.col("high") + F.when(F.col("trusted") * (1 - high) < 1, further).otherwise(0.0),
        }
    )
    for scale in ("falling", "rising"):
        least = _quantiles(known.select(*by, F.col(scale).alias("score")), by, VARIED, 1.0)
        # Few documents do not show the quantile; their least value lies above it.
        fewer = F.col("low") * F.col("trusted") / (F.col("trusted") + 2)
        out = out.join(least.select(*by, fewer.alias(scale)), by)
    return out


def classify(
    docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH, least: int = LEAST_TRUSTED
) -> DataFrame:
    """One row per document: doc_id, h, lang, length, perplexity, low, high, kept.

    Trusted are the texts labelled of good quality and not toxic. A document is kept if its
    log perplexity lies between the ``low`` and ``high`` quantiles of the trusted documents
    of its language, however few (null is a language of its own). A language with fewer than
    ``least``, by default with none, has no limits: its texts with characters are kept, not
    judged by those of another language. A text that repeats itself, with fewer distinct
    trigrams for its length than the ``VARIED`` quantile of the trusted ones on both scales
    of :func:`_variety`, is not kept, nor are texts without characters. Documents equal in id and text get equal rows.
    """
    trusted = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    trusted = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    trusted = materialise(trusted, "trusted-ids")
    scores = perplexities(docs, trusted)
    known = scores.filter("score IS NOT NULL").join(trusted, "doc_id", "left_semi")
    falling, rising = _variety()
    known = known.select(_language(), "score", falling.alias("falling"), rising.alias("rising"))
    known = materialise(known, "trusted-scores")
    own = _limits(known, ["language"], low, high).filter(F.col("trusted") >= least)
    rows = lookup_join(scores.withColumn("language", _language()), own, ["language"])
    rows = rows.withColumns(
        {
            "low": F.coalesce("low", F.lit(0.0)),
            "high": F.coalesce("high", F.lit(float("inf"))),
            "falling": F.coalesce("falling", F.lit(0.0)),
            "rising": F.coalesce("rising", F.lit(0.0)),
        }
    )
    varied = (falling >= F.col("falling")) | (rising >= F.col("rising"))
    kept = F.coalesce(F.col("score").between(F.col("low"), F.col("high")) & varied, F.lit(False))
    return rows.select(
        "doc_id", "h", "lang", "length", F.exp("score").alias("perplexity"),
        F.exp("low").alias("low"), F.exp("high").alias("high"), kept.alias("kept"),
    )


def _language() -> Column:
    """The language with null as a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("language")


def good_documents(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents the classifier keeps."""
    found = materialise(classify(docs, labels, **settings), "quality")
    return without(docs, found.filter("NOT kept"))
