"""Logistic regression by full-batch gradient descent.

Features are numeric columns and index columns (the codes of one-hot blocks). A
one-hot block is never expanded: its share of a score is one array lookup, its
share of the gradient a sum of residuals by code. Rows with equal features are folded
to one weighted row before the first step, so a step reads distinct rows only.

Folded rows of up to ``HELD_BYTES`` (counted, not guessed) are held by one task that
makes many steps in one job. Beyond that every step is one scan of packed rows that lie
mapped into memory where the tasks run (``pieces``), columns that take few values together
sharing a dictionary (``grouped``): each task adds up the gradient of its rows as one vector,
and the vectors meet in the shared folder or on the driver (``steps``). With ``stateDir`` the state is written every ``stateEvery`` steps, and a
fit with the same data and settings goes on from the last state found there.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.numeric import sigmoid
from headway.operators.grouped import blocks, compressed
from headway.operators.pieces import Pieces, piece_number
from headway.operators.steps import Steps
from headway.session import materialise, ship_code


# So many vectors reach the driver in a step; more are summed by fewer tasks first.
FEW_VECTORS = 8

# Places that share a generator of start weights.
START_BLOCK = 65_536

# Folded rows of up to this size are held by one task; 8 bytes a number, 4 a code.
HELD_BYTES = 128 * 1024 * 1024

# Rows that a scan reads as one byte string each for numbers and codes.
PACKED_ROWS = 65_536


class _Columns(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric features", TypeConverters.toListString)
    indexCols = Param(Params._dummy(), "indexCols", "codes of one-hot blocks", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "score for class 1", TypeConverters.toFloat)


def _literal_array(values) -> Column:
    """A constant array in the plan from one string, however long."""
    if len(values) == 0:
        return F.array().cast("array<double>")
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def linear_score(
    intercept: float, numeric: dict[str, float], blocks: dict[str, list[float]]
) -> Column:
    """intercept + sum of weight * feature; a code without a weight adds nothing."""
    score = F.lit(float(intercept))
    for name, weight in numeric.items():
        score = score + F.lit(float(weight)) * F.col(name)
    for name, weights in blocks.items():
        known = F.get(_literal_array(weights), F.col(name).cast("int"))
        score = score + F.coalesce(known, F.lit(0.0))
    return score


@dataclass
class State:
    """What a step needs of the steps before it."""

    bias: float
    weights: np.ndarray
    step: int = 0
    history: list[float] = field(default_factory=list)
    done: bool = False


@dataclass(frozen=True)
class Rules:
    """How a step changes the state."""

    rows: float
    rate: float
    alpha: float
    tol: float
    eps: float
    fit_bias: bool
    joint: bool
    most: int

    def sums(self, state: State, columns: list[np.ndarray], numbers: int, starts: np.ndarray) -> np.ndarray:
        """Sums of the loss, of the residual and of residual * feature over weighted rows (n, positives, features)."""
        return self.parts(state, columns, numbers, starts)[0]

    def parts(
        self, state: State, columns: list[np.ndarray], numbers: int, starts: np.ndarray, offset=0.0
    ) -> tuple[np.ndarray, np.ndarray]:
        """The sums, and the residual of each row; ``offset`` is the part of the scores that lies elsewhere."""
        w = state.weights
        n, s, x = columns[0], columns[1], np.array(columns[2 : 2 + numbers]).reshape(numbers, -1)
        score = state.bias + w[:numbers] @ x + offset
        one_more = np.append(w, 0.0)  # of codes without a weight
        for column, start in zip(columns[2 + numbers :], starts, strict=False):
            score += one_more[np.where(column >= 0, column + int(start), len(w)).astype(np.int64)]
        p = 1.0 / (1.0 + np.exp(-score))
        residual = n * p - s
        total = np.zeros(len(w) + 2)
        total[0] = -np.sum(s * np.log(p + self.eps) + (n - s) * np.log(1 - p + self.eps))
        total[1] = residual.sum()
        total[2 : 2 + numbers] = x @ residual
        for column, start in zip(columns[2 + numbers :], starts, strict=False):
            known = column >= 0
            found = np.bincount(column[known], residual[known])  # as long as the largest code of the block
            total[2 + int(start) : 2 + int(start) + len(found)] += found
        return total, residual

    def after(self, state: State, total: np.ndarray, squares: tuple[float, float] = (0.0, 0.0)) -> State:
        """The state one step on; done when the slopes are short enough or the steps used up.

        ``squares`` are the sums of squared new weights and of squared slopes that lie elsewhere.
        """
        loss, bias_slope, slope = total[0] / self.rows, total[1] / self.rows, total[2:] / self.rows
        slope = slope + self.alpha * state.weights
        weights = state.weights - self.rate * slope
        bias = state.bias - self.rate * bias_slope if self.fit_bias else state.bias
        loss = float(loss + self.alpha / 2 * (np.sum(weights**2) + squares[0]))
        norm = np.linalg.norm(np.append(slope, bias_slope) if self.joint and self.fit_bias else slope)
        norm = math.hypot(norm, math.sqrt(squares[1]))
        step = state.step + 1
        return State(float(bias), weights, step, [*state.history, loss], bool(norm < self.tol) or step >= self.most)


def start_weights(seed: int, scale: float, places: np.ndarray) -> np.ndarray:
    """Start weights by place; each block of places has a generator of its own, so that tasks can draw theirs."""
    out = np.empty(len(places))
    blocks = places // START_BLOCK
    for block in np.unique(blocks):
        draws = np.random.default_rng([seed, int(block)] if block else seed).normal(0.0, scale, START_BLOCK)
        here = blocks == block
        out[here] = draws[places[here] % START_BLOCK]
    return out


STATE = "signature string, step int, bias double, weights array<double>, history array<double>, done boolean"
_STATE = pa.schema(
    [("step", pa.int32()), ("bias", pa.float64()), ("weights", pa.list_(pa.float64())),
     ("history", pa.list_(pa.float64())), ("done", pa.bool_())]
)


def _saved(spark, folder: str, signature: str) -> State | None:
    """The last state of this fit in a folder, if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = spark.read.schema(STATE).parquet(folder).filter(F.col("signature") == signature)
    last = rows.orderBy(F.desc("step")).first()
    return last and State(last.bias, np.array(last.weights), last.step, list(last.history), last.done)


def _save(spark, folder: str, signature: str, state: State) -> None:
    row = (signature, state.step, state.bias, state.weights.tolist(), state.history, state.done)
    spark.createDataFrame([row], STATE).coalesce(1).write.mode("append").parquet(folder)


class GradientDescentLogistic(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """``biasInWeights`` treats the bias as one more weight: random start, part of the gradient norm."""

    learningRate = Param(Params._dummy(), "learningRate", "step size", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "most steps", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "gradient norm to stop at", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "L2 penalty, bias excluded", TypeConverters.toFloat)
    fitIntercept = Param(Params._dummy(), "fitIntercept", "fit a bias", TypeConverters.toBoolean)
    biasInWeights = Param(Params._dummy(), "biasInWeights", "bias variant", TypeConverters.toBoolean)
    eps = Param(Params._dummy(), "eps", "added inside logarithms", TypeConverters.toFloat)
    startScale = Param(Params._dummy(), "startScale", "deviation of start weights", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of start weights", TypeConverters.toInt)
    stateDir = Param(Params._dummy(), "stateDir", "folder of written states; none if empty", TypeConverters.toString)
    stateEvery = Param(Params._dummy(), "stateEvery", "steps between written states", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, numericCols=None, indexCols=None, labelCol="is_delayed", learningRate=0.05,
        maxIter=800, tol=1e-4, alpha=0.001, fitIntercept=True, biasInWeights=False, eps=1e-12,
        startScale=0.01, seed=42, threshold=0.5, stateDir="", stateEvery=500,
    ):
        super().__init__()
        self._setDefault(
            numericCols=[], indexCols=[], labelCol="is_delayed", learningRate=0.05, maxIter=800,
            tol=1e-4, alpha=0.001, fitIntercept=True, biasInWeights=False, eps=1e-12,
            startScale=0.01, seed=42, threshold=0.5, stateDir="", stateEvery=500,
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> GradientDescentLogisticModel:
        spark = df.sparkSession
        ship_code(spark)
        get = self.getOrDefault
        numeric, index, label = get("numericCols"), get("indexCols"), get("labelCol")
        features = [
            *[F.col(c).cast("double").alias(c) for c in numeric],
            *[F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c) for c in index],  # -1: no weight
        ]
        plain = df.select(F.col(label).cast("double").alias("_y"), *features)
        folded = plain.groupBy(*numeric, *index).agg(
            F.count("_y").cast("double").alias("_n"), F.sum("_y").alias("_s"),
            F.min("_y").alias("_low"), F.max("_y").alias("_high"),
        )
        rows = materialise(folded.filter("_n > 0"), "descent")
        checks = rows.agg(
            F.count(F.lit(1)), F.sum("_n"), F.sum("_s"), F.min("_low"), F.max("_high"),
            *[F.coalesce(F.max(c), F.lit(-1)) + 1 for c in index],
        ).first()
        distinct, n, positives, low, high, *sizes = checks
        if low == high:
            raise ValueError("gradient descent needs two classes")
        if low < 0 or high > 1:
            raise ValueError("the label must be 0 or 1")

        starts = np.cumsum([len(numeric), *sizes])
        size = int(starts[-1])
        joint, with_bias = get("biasInWeights"), get("fitIntercept")
        draw = start_weights(get("seed"), get("startScale"), np.arange(size + int(joint and with_bias)))
        state = State(float(draw[0]), draw[1:]) if joint and with_bias else State(0.0, draw)
        rules = Rules(
            n, get("learningRate"), get("alpha"), get("tol"), get("eps"), with_bias, joint, get("maxIter")
        )
        names = ("learningRate", "alpha", "eps", "fitIntercept", "biasInWeights", "startScale", "seed")
        signature = json.dumps([[get(k) for k in names], numeric, index, distinct, n, positives, sizes])
        folder = get("stateDir")
        if folder and (found := _saved(spark, folder, signature)):
            # a state that met its stop rule may have to go on under another one
            state = State(found.bias, found.weights, found.step, found.history, found.done and found.step >= rules.most)

        rows = rows.select("_n", "_s", *numeric, *index)
        held = distinct * (8 * (2 + len(numeric)) + 4 * len(index)) <= HELD_BYTES
        if not held:
            # rows of a level lie together, so that a packed row has few of them
            order = sorted(range(len(index)), key=lambda i: -sizes[i])
            spread = rows.repartition(piece_number(spark, distinct), *rows.columns)
            spread = spread.sortWithinPartitions(*[index[i] for i in order], *rows.columns)
            pieces = Pieces(spread, "packed", grouped_rows(len(numeric), [int(s) for s in starts[:-1]], size))
            steps = Steps(pieces, rules, size)
        while not state.done:
            until = min(rules.most, state.step + get("stateEvery"))
            if held:
                state = self._held(rows, state, until, rules, len(numeric), starts)
            else:
                state = steps.advanced(state, until)
            if folder:
                _save(spark, folder, signature, state)
        if not held:
            steps.close()
            pieces.close()

        model = GradientDescentLogisticModel()
        model._set(
            numericCols=numeric, indexCols=index, labelCol=label, threshold=get("threshold"),
            intercept=float(state.bias), weights=[float(w) for w in state.weights],
            blockSizes=[int(s) for s in sizes], lossHistory=state.history,
        )
        return model._resetUid(self.uid.replace("GradientDescentLogistic", "GradientDescentLogisticModel"))

    @staticmethod
    def _held(rows, state: State, until: int, rules: Rules, numbers: int, starts) -> State:
        """The state after further steps in one task, which reads the rows once."""
        shared = rows.sparkSession.sparkContext.broadcast(state)

        def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, parts = shared.value, list(batches)
            columns = [
                np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in parts])
                for k in range(parts[0].num_columns)
            ]
            while now.step < until and not now.done:
                now = rules.after(now, rules.sums(now, columns, numbers, starts))
            found = [[now.step], [now.bias], [now.weights.tolist()], [now.history], [now.done]]
            arrays = [pa.array(v, f.type) for v, f in zip(found, _STATE, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=_STATE)

        # sorted, so that sums come out alike in every run
        one = rows.coalesce(1).sortWithinPartitions(*rows.columns)
        last = one.mapInArrow(descend, STATE.removeprefix("signature string, ")).first()
        shared.destroy()
        return State(last.bias, np.array(last.weights), last.step, list(last.history), last.done)


def grouped_rows(numbers: int, starts: list[int], none: int, wide: bool = False):
    """Makes packed rows with dictionaries from the batches of a partition."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = packed_batches(batches, 2 + numbers + 2 * wide)
        return compressed(blocks(plain, 2 + numbers, starts, none, wide), wide)

    return pack


def packed_batches(batches: Iterator[pa.RecordBatch], numbers: int) -> Iterator[pa.RecordBatch]:
    """Rows as two byte strings, the numbers and the codes column by column."""

    def joined(found: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [c.to_numpy() for c in pa.Table.from_batches(found).columns]
        parts = [
            b"".join(c.astype(kind).tobytes() for c in some)
            for some, kind in ((columns[:numbers], np.float64), (columns[numbers:], np.int32))
        ]
        return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], ["numbers", "codes"])

    waiting, count = [], 0
    for batch in batches:
        waiting.append(batch)
        count += batch.num_rows
        if count >= PACKED_ROWS:
            yield joined(waiting)
            waiting, count = [], 0
    if count:
        yield joined(waiting)


def packed(rows: DataFrame, numbers: int) -> DataFrame:
    """Batches of weighted rows, positives, ``numbers`` numbers and codes as two byte strings."""
    return rows.mapInArrow(lambda batches: packed_batches(batches, 2 + numbers), "numbers binary, codes binary")


def summed(sums: DataFrame, parts: int) -> np.ndarray:
    """The sum of a vector per part (column total), added up by fewer and fewer tasks."""
    while parts > FEW_VECTORS:
        parts = max(FEW_VECTORS // 2, math.isqrt(parts))
        sums = sums.repartition(parts).mapInArrow(_added, "total binary")
    return sum(np.frombuffer(r[0]) for r in sums.collect())  # a vector per task of the last level


def _vector(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for data in batch.column(0).to_pylist():
            vector = np.frombuffer(data)
            total = vector.copy() if total is None else total + vector
    if total is not None:
        yield _vector(total)


class GradientDescentLogisticModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    intercept = Param(Params._dummy(), "intercept", "bias", TypeConverters.toFloat)
    weights = Param(Params._dummy(), "weights", "numeric, then block weights", TypeConverters.toListFloat)
    blockSizes = Param(Params._dummy(), "blockSizes", "levels per block", TypeConverters.toListInt)
    lossHistory = Param(Params._dummy(), "lossHistory", "loss per step", TypeConverters.toListFloat)

    def score_column(self) -> Column:
        get = self.getOrDefault
        numeric, weights = get("numericCols"), get("weights")
        blocks, start = {}, len(numeric)
        for name, size in zip(get("indexCols"), get("blockSizes"), strict=True):
            blocks[name] = weights[start : start + size]
            start += size
        return linear_score(get("intercept"), dict(zip(numeric, weights, strict=False)), blocks)

    def probability_column(self) -> Column:
        return sigmoid(self.score_column())

    def prediction_column(self) -> Column:
        return (self.probability_column() >= self.getOrDefault("threshold")).cast("double")

    def _transform(self, df: DataFrame) -> DataFrame:
        score, p = F.col("_score"), sigmoid(F.col("_score"))
        return (
            df.withColumn("_score", self.score_column())
            .withColumns(
                {
                    "rawPrediction": array_to_vector(F.array(-score, score)),
                    "probability": array_to_vector(F.array(1 - p, p)),
                    "prediction": (p >= self.getOrDefault("threshold")).cast("double"),
                }
            )
            .drop("_score")
        )

    def accuracy(self, df: DataFrame) -> float:
        """Share of rows whose predicted class is the label."""
        hit = (self.prediction_column() == F.col(self.getOrDefault("labelCol"))).cast("int")
        return df.agg(F.avg(hit)).first()[0]
