"""Mixing sources to target weights on a low-discrepancy schedule.

Multiples of the golden ratio, taken modulo one, are mapped through the cumulative
weights of the sources: slot j of the mix belongs to the source whose interval holds the
j-th point, so that every stretch of the mix has nearly the target shares. The slots of a
source are ranked; rank r takes block r of the source's shuffled words, cut into blocks of
equal tokens, and starts the blocks anew after the last one. A source leaves the schedule
when its target is taken, the last block in part; slots that the finite schedule leaves
short of a target follow at its end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from headway.llm.common import document_keys
from headway.operators.ordering import in_order
from headway.session import materialise

BLOCK = 1024
MAX_SOURCES = 100_000
WEIGHTS = (5.0, 2.0, 1.0)
SLOT_RUN = 65_536
GOLDEN = 0x9E3779B97F4A7C15
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Source:
    name: str | None
    number: int
    size: int
    target: float


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Weighted shares of ``share`` times all sizes; none above ``most`` times its size.

    What is cut off a source is shared anew, by weight, among the others until none is above.
    """
    left = share * sum(sizes)
    out = [0.0] * len(sizes)
    free = list(range(len(sizes)))
    while free:
        rate = left / sum(weights[i] for i in free)
        above = {i for i in free if weights[i] * rate > most * sizes[i]}
        for i in above or free:
            out[i] = most * sizes[i] if above else weights[i] * rate
        left -= sum(out[i] for i in above)
        free = [i for i in free if i not in above] if above else []
    return out


def sources_of(rows: DataFrame, weights: tuple[float, ...], share: float, most: float) -> list[Source]:
    """The sources by code point, null last; one number each is held by the driver.

    A mix by more than MAX_SOURCES weights is refused.
    """
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(r[1]) for r in found]
    cycle = [weights[i % len(weights)] for i in range(len(found))]
    goals = targets(sizes, cycle, share, most)
    return [Source(r[0], i, s, t) for i, (r, s, t) in enumerate(zip(found, sizes, goals, strict=True))]


def _frame(rows: DataFrame, sources: list[Source]) -> DataFrame:
    schema = T.StructType(
        [T.StructField("source", T.StringType()), T.StructField("src", T.IntegerType()),
         T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())]
    )
    data = [(s.name, s.number, s.size, s.target) for s in sources]
    return rows.sparkSession.createDataFrame(data, schema)


def _slots(goal: int, size: int, block: int) -> int:
    """Slots that take ``goal`` words of a source; the last block of every epoch may be short."""
    if not size:
        return 0
    epochs, rest = divmod(goal, size)
    return epochs * -(-size // block) + -(-rest // block)


def schedule(rows: DataFrame, sources: list[Source], block: int) -> DataFrame:
    """(slot, src, block, epoch, words): which block each slot of the mix takes, and how many words of it."""
    spark = rows.sparkSession
    goals = [int(s.target + 0.5) for s in sources]
    quota = [_slots(g, s.size, block) for g, s in zip(goals, sources, strict=True)]
    slots = sum(quota)
    edges = np.array(list(accumulate(quota)), dtype=np.float64) / max(slots, 1)

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            j = batch.column(0).to_numpy(zero_copy_only=False)
            turns = (j.astype(np.uint64) + np.uint64(1)) * np.uint64(GOLDEN)
            point = (turns >> np.uint64(11)).astype(np.float64) / float(1 << 53)
            src = np.searchsorted(edges, point, side="right")
            src = np.minimum(src, max(len(edges) - 1, 0)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(j), pa.array(src), pa.array(j // SLOT_RUN)], names=["slot", "src", "run"]
            )

    drawn = spark.range(slots).mapInArrow(points, "slot long, src int, run long")
    counts = drawn.groupBy("src", "run").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("src").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    counts = materialise(counts, "slot-counts")
    inside = Window.partitionBy("src", "run").orderBy("slot")
    ranked = (
        drawn.withColumn("nth", F.row_number().over(inside))
        .join(counts.select("src", "run", "before"), ["src", "run"])
        .select("slot", "src", (F.col("before") + F.col("nth") - 1).alias("rank"))
    )
    drawn_of = {r[0]: r[1] for r in counts.groupBy("src").agg(F.sum("n")).collect()}
    short = [(s.number, drawn_of.get(s.number, 0), quota[s.number]) for s in sources]
    ends = list(accumulate((max(0, q - d) for _, d, q in short), initial=slots))
    gaps = [(n, d, q, e) for (n, d, q), e in zip(short, ends[:-1], strict=True) if q > d]
    tail = spark.createDataFrame(gaps, "src int, first long, stop long, slot long").select(
        "src", "slot", "first", F.explode(F.sequence("first", F.col("stop") - 1)).alias("rank")
    )
    ranked = ranked.unionByName(
        tail.select((F.col("slot") + F.col("rank") - F.col("first")).alias("slot"), "src", "rank")
    )
    plan = spark.createDataFrame(
        [(s.number, goals[s.number], max(1, -(-s.size // block))) for s in sources],
        "src int, goal long, blocks long",
    )
    # The words of an epoch are source-sized; its last block is shorter than the others.
    sized = _sizes(rows, sources)
    return (
        ranked.join(F.broadcast(plan), "src")
        .join(F.broadcast(sized), "src")
        .withColumns({"block": F.expr("rank % blocks"), "epoch": F.expr("rank div blocks")})
        .withColumn("words", F.least(
            F.lit(block), F.col("total") - F.col("block") * block,
            F.col("goal") - F.col("epoch") * F.col("total") - F.col("block") * block,
        ))
        .filter("words > 0")
        .select("slot", "src", "block", "epoch", "words")
    )


def _sizes(rows: DataFrame, sources: list[Source]) -> DataFrame:
    return rows.sparkSession.createDataFrame([(s.number, s.size) for s in sources], "src int, total long")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, h, source, size): the number of words of every document; null has none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return document_keys(
        docs,
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    )


def _laid_out(rows: DataFrame, seed: int) -> DataFrame:
    """The documents of each source in shuffled order, with the words before each (``start``)."""
    shuffled = F.xxhash64(F.lit(seed), "doc_id", "h")
    table = in_order(
        rows.withColumn("_at", shuffled), [F.col("src"), F.col("_at"), F.col("doc_id")], "mix-order"
    )
    sums = table.groupBy("src", "_part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("src").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(
        sums.select("src", "_part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before")),
        "mix-offsets",
    )
    inside = Window.partitionBy("src", "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("size").over(inside), F.lit(0))
    return (
        table.withColumn("within", within)
        .join(offsets, ["src", "_part"])
        .withColumn("start", F.col("before") + F.col("within"))
        .withColumn("row", F.struct("_part", "_pos"))
        .drop("_part", "_pos", "_at", "before", "within")
    )


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = 1.5,
    most: float = 2.0,
    block: int = BLOCK,
    seed: int = 0,
) -> DataFrame:
    """One row per document: doc_id, h, source, size, source_size, target, taken, first, second.

    ``taken`` counts the words the mix takes of a document, repeats included; ``first`` and
    ``second`` are the parts of it from the first and from later epochs. The taken words of
    a source sum to its target, rounded. Documents without words are taken 0 times; null is
    a source of its own, the last. Equal rows share out what they take, and an empty table
    stays empty. The order depends on ids, texts and ``seed`` only.
    """
    rows = materialise(sizes(docs), "mix-sizes")
    sources = sources_of(rows, weights, share, most)
    frame = _frame(rows, sources)
    numbered = rows.join(F.broadcast(frame), rows["source"].eqNullSafe(frame["source"])).select(
        "doc_id", "h", "src", "size"
    )
    laid = materialise(_laid_out(numbered, seed), "mix-layout")
    pieces = laid.filter("size > 0").select(
        "row", "src", "start", "size",
        F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block"),
    )
    use = schedule(rows, sources, block)
    from_, to = F.col("block") * block, F.col("block") * block + F.col("words")
    overlap = F.least(F.col("start") + F.col("size"), to) - F.greatest(F.col("start"), from_)
    taken = (
        pieces.join(use, ["src", "block"])
        .withColumn("words", F.greatest(overlap, F.lit(0)))
        .groupBy("row")
        .agg(
            F.sum("words").alias("taken"),
            F.sum(F.when(F.col("epoch") == 0, F.col("words")).otherwise(0)).alias("first"),
        )
    )
    zero = F.lit(0).cast("long")
    return (
        laid.join(taken, "row", "left")
        .join(F.broadcast(frame), "src")
        .select(
            "doc_id", "h", "source", "size", "source_size", "target",
            F.coalesce("taken", zero).alias("taken"),
            F.coalesce("first", zero).alias("first"),
            F.coalesce(F.col("taken") - F.col("first"), zero).alias("second"),
        )
    )


def _epochs() -> Column:
    """How often a document enters the mix: once per epoch that takes at least half of it."""
    once = (F.col("first") * 2 >= F.col("size")).cast("int")
    again = F.round(F.col("second") / F.col("size")).cast("int")
    return F.when(F.col("size") == 0, F.lit(0)).otherwise(once + again)


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents as the mix takes them, whole: each as often as epochs take at least half of it.

    Rows equal in id and text are represented by one of them.
    """
    names = docs.columns
    copies = (
        mix(docs, **settings)
        .select("doc_id", "h", _epochs().alias("copies"))
        .groupBy("doc_id", "h")
        .agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    )
    copies = materialise(copies.filter("copies > 0"), "mix-copies")
    whole = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    rows = document_keys(docs, whole).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "row")
    same = rows["_id"].eqNullSafe(copies["doc_id"]) & (rows["_h"] == copies["h"])
    taken = rows.join(copies.hint("shuffle_hash"), same).select("_id", "_h", "row", "copies", "rows")
    alone = taken.filter("rows = 1").select("row", "copies")
    several = taken.filter("rows > 1").groupBy("_id", "_h")
    several = several.agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
    out = alone.unionByName(several.select("row", "copies"))
    return out.select("row", F.explode(F.expr("sequence(1, cast(copies as int))"))).select("row.*")
