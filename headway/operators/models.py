"""The three delay classifiers as ``pyspark.ml`` pipelines.

Fitted statistics (medians, scales, frequent stops, level encodings) are baked
into ``SQLTransformer`` stages, so a saved pipeline scores raw rows by itself and
scoring is one map-only job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schema as S
from headway.operators import encoding, forest, wide_logistic
from headway.operators.gradient_descent import GradientDescentLogistic
from headway.operators.wide_descent import WideDescentLogistic, WideDescentModel
from headway.session import materialise

FOREST_CATEGORICAL = S.TARGET_ENCODED + S.ORDINAL_ENCODED


def _literal(value: float) -> str:
    return f"{value!r}D"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _select(columns: dict[str, str]) -> SQLTransformer:
    parts = ", ".join(f"{sql} AS `{name}`" for name, sql in columns.items())
    return SQLTransformer(statement=f"SELECT *, {parts} FROM __THIS__")


# ---- linear models ---------------------------------------------------------


def filled_stage(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> tuple[Model, list[str], list[str]]:
    """Median fill, scaling and most-frequent fill as one stage, with its output columns."""
    medians = encoding.fit_medians(train, numeric)
    numeric = [c for c in numeric if c in medians]  # a column without any value has no median
    scaling = encoding.fit_scaling(encoding.fill_medians(train, medians), numeric)
    modes = encoding.most_frequent(train, categorical)
    columns = {
        f"{c}_scaled": f"(coalesce(cast(`{c}` as double), {_literal(medians[c])})"
        f" - {_literal(scaling[c][0])}) / {_literal(scaling[c][1])}"
        for c in numeric
    } | {
        f"{c}_filled": f"coalesce(cast(`{c}` as string), {_text(modes.get(c, S.MISSING))})"
        for c in categorical
    }
    return _select(columns), [f"{c}_scaled" for c in numeric], [f"{c}_filled" for c in categorical]


def linear_stages(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> tuple[list[Model], list[str], list[str]]:
    """Median fill, scaling, most-frequent fill and level codes, with their output columns."""
    fill, scaled, filled = filled_stage(train, numeric, categorical)
    indexer, encoder = encoding.fit_one_hot(fill.transform(train), filled)
    return [fill, indexer, encoder], scaled, indexer.getOutputCols()


def assembled(stages: list[Model], numeric: Sequence[str]) -> list[Model]:
    """The stages followed by one sparse feature vector."""
    encoder = stages[-1]
    return [
        *stages,
        VectorAssembler(inputCols=[*numeric, *encoder.getOutputCols()], outputCol="features"),
    ]


def weighted_vectors(
    stages: list[Model], train: DataFrame, label: str, weights: dict[int, float]
) -> DataFrame:
    """Feature vector, label and class weight, written once: a fit reads its input several times."""
    vectors = PipelineModel(stages).transform(train).select("features", label)
    return materialise(encoding.add_class_weight(vectors, label, weights), "vectors")


def fit_logistic(
    train: DataFrame,
    label: str = "is_delayed",
    numeric: Sequence[str] = S.LINEAR_NUMERIC,
    categorical: Sequence[str] = S.LINEAR_CATEGORICAL,
    max_iter: int = 1000,
    max_levels: int = encoding.MAX_LEVELS,
) -> PipelineModel:
    """Balanced logistic regression with an L2 penalty of one half on the summed loss.

    The loss here is an average over weighted rows, and balanced weights add up to
    the number of rows, hence the penalty 1 / rows. One column may have more than ``max_levels``
    levels; their weights are then found where the rows are and lie in a written table.
    """
    fill, scaled, filled = filled_stage(train, numeric, categorical)
    weights = encoding.class_weights(train, label)
    try:
        indexer, encoder = encoding.fit_one_hot(fill.transform(train), filled, max_levels)
    except encoding.TooManyLevels:
        wide = wide_logistic.fit(fill.transform(train), label, scaled, filled, weights, max_levels, max_iter)
        return PipelineModel([fill, wide])
    stages = assembled([fill, indexer, encoder], scaled)
    rows = weighted_vectors(stages, train, label, weights)
    model = LogisticRegression(
        featuresCol="features", labelCol=label, weightCol="class_weight", maxIter=max_iter,
        regParam=1.0 / train.count(), elasticNetParam=0.0, standardization=False,
    ).fit(rows)
    return PipelineModel([*stages, model])


def fit_gradient_descent(
    train: DataFrame,
    label: str = "is_delayed",
    numeric: Sequence[str] = S.LINEAR_NUMERIC,
    categorical: Sequence[str] = S.LINEAR_CATEGORICAL,
    max_levels: int = encoding.MAX_LEVELS,
    **settings,
) -> PipelineModel:
    """Gradient descent on one-hot columns; a column with more than ``max_levels`` levels is
    fitted with the weights in a written table instead of on the driver, with the same result."""
    fill, scaled, filled = filled_stage(train, numeric, categorical)
    try:
        indexer, _ = encoding.fit_one_hot(fill.transform(train), filled, max_levels)
    except encoding.TooManyLevels:
        wide = WideDescentLogistic(
            numericCols=scaled, levelCols=filled, labelCol=label, heldLevels=max_levels, **settings
        )
        return PipelineModel([fill, wide.fit(fill.transform(train))])
    indexed, codes = [fill, indexer], indexer.getOutputCols()
    levels = {c: len(labels) for c, labels in zip(codes, indexer.labelsArray, strict=True)}
    known = {f"{c}_known": f"if(`{c}` < {n}, cast(`{c}` as int), null)" for c, n in levels.items()}
    indexed.append(_select(known))
    model = GradientDescentLogistic(
        numericCols=scaled, indexCols=list(known), labelCol=label, **settings
    ).fit(PipelineModel(indexed).transform(train))
    return PipelineModel([*indexed, model])


def coefficients(model: PipelineModel, example: DataFrame) -> DataFrame:
    """Name and signed weight of every feature; ``example`` supplies the columns, no rows are read."""
    last = model.stages[-1]
    spark = example.sparkSession
    if isinstance(last, WideDescentModel):
        return last.coefficient_table(spark)
    if hasattr(last, "coefficients"):
        attributes = model.transform(example).schema["features"].metadata["ml_attr"]["attrs"]
        named = [(a["idx"], a["name"]) for group in attributes.values() for a in group]
        names = [name for _, name in sorted(named)]
        values = last.coefficients.toArray().tolist()
    else:
        indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
        names = list(last.getOrDefault("numericCols"))
        for column, labels in zip(indexer.getInputCols(), indexer.labelsArray, strict=True):
            names += [f"{column}_onehot_{level}" for level in labels]
        values = last.getOrDefault("weights")
    rows = [(n, float(v)) for n, v in zip(names, values, strict=False)]
    return spark.createDataFrame(rows, "feature string, coefficient double")


def logistic_slopes(model: PipelineModel, train: DataFrame, label: str) -> DataFrame:
    """Slope of the penalised, class-weighted mean loss in each coefficient; zero at the optimum."""
    last = model.stages[-1]
    weights = encoding.class_weights(train, label)
    scored = encoding.add_class_weight(model.transform(train), label, weights)
    residual = F.col("class_weight") * (vector_to_array("probability")[1] - F.col(label))
    # weights of a summary cannot be negative, so residuals above and below zero are summed apart
    above = Summarizer.metrics("sum").summary(F.col("features"), F.greatest(residual, F.lit(0.0)))
    below = Summarizer.metrics("sum").summary(F.col("features"), F.greatest(-residual, F.lit(0.0)))
    row = scored.agg(above["sum"], below["sum"], F.sum("class_weight")).first()
    slopes = (row[0].toArray() - row[1].toArray()) / row[2]
    slopes = slopes + last.getOrDefault("regParam") * last.coefficients.toArray()
    names = [r["feature"] for r in coefficients(model, train).collect()]
    rows = list(zip(names, map(float, slopes), strict=True))
    return train.sparkSession.createDataFrame(rows, "feature string, slope double")


# ---- forest ----------------------------------------------------------------


NAMED_SUBSETS = {"sqrt": "sqrt", "log2": "log2", "auto": "all", "none": "all", "all": "all"}


def feature_subset(setting: str | float | None) -> str:
    """Spark's ``featureSubsetStrategy`` for a name, a share (below one) or a number of features.

    None means all of them; text that is neither a name nor a positive number is an error.
    """
    named = NAMED_SUBSETS.get(str(setting).strip().lower())
    if named:
        return named
    if not re.fullmatch(r"[0-9]*[.]?[0-9]+", str(setting).strip()) or float(setting) == 0:
        raise ValueError(f"max_features {setting!r} is neither a name nor a positive number")
    share = float(setting)
    return repr(share) if share < 1 else f"{share:.0f}"


def rows_per_tree(setting: float | None, rows: int) -> float:
    """Spark's ``subsamplingRate`` for a share of the rows (up to one) or a number of rows."""
    if not setting:
        return 1.0
    if setting < 0:
        raise ValueError("max_samples must be positive")
    return min(1.0, setting / rows if setting > 1 else setting)


@dataclass
class ForestSettings:
    trees: int = 100
    max_depth: int = 14
    min_leaf: int = 25
    max_features: str | float | None = "log2"
    max_samples: float | None = 0.3
    top_stops: int = 300
    seed: int = 42
    smoothing: float = 10.0
    min_rows: float = 20.0
    # Candidate split values per feature; days, stops and routes have a few hundred values.
    max_bins: int = 256
    # Drawn rows up to which one task finishes a sub-tree; 0 grows whole trees level by level,
    # with Spark's own fit and `memory_mb` for the histograms of a pass.
    hand_over: int = 500_000
    memory_mb: int = 2048


def level_counts(train: DataFrame, columns: dict[str, str], label: str) -> DataFrame:
    """Rows (``n``) and positive rows per (column, level), all columns in one pass; ``columns`` holds SQL."""
    parts = ", ".join(f"'{c}', {sql}" for c, sql in columns.items())
    return (
        train.select(F.col(label).alias("_y"), F.expr(f"stack({len(columns)}, {parts}) as (column, level)"))
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("positive"))
    )


def forest_stages(
    train: DataFrame, label: str, settings: ForestSettings
) -> tuple[list[Model], dict[int, float]]:
    """Stop bucketing, fills, target and ordinal encodings, numbers passed through; and the class weights.

    Counts per level give the frequent stops, the levels, both encodings and the class sizes.
    """
    filled = {c: f"coalesce(cast(`{c}` as string), {_text(S.MISSING)})" for c in FOREST_CATEGORICAL}
    counts = materialise(level_counts(train, filled, label), "levels")
    if settings.top_stops > 0:
        # the most frequent stops of the fit split, at most `top_stops` names
        is_stop = F.col("column") == "stop_id"
        known = counts.where(is_stop & (F.col("level") != S.MISSING))
        stops = [r["level"] for r in known.orderBy(F.desc("n"), "level").limit(settings.top_stops).collect()]
        listed = ", ".join(_text(s) for s in stops) or "NULL"
        filled["stop_id"] = f"if(`stop_id` in ({listed}), `stop_id`, {_text(S.OTHER)})"
        rare = is_stop & ~F.col("level").isin(stops)
        counts = (
            counts.withColumn("level", F.when(rare, S.OTHER).otherwise(F.col("level")))
            .groupBy("column", "level")
            .agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
        )
    sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}
    too_many = [c for c, n in sizes.items() if n > encoding.MAX_LEVELS]
    if too_many:
        raise ValueError(f"too many levels to index: {', '.join(too_many)}; bucket rare ones first")
    found: dict[str, dict[str, tuple[int, int]]] = {c: {} for c in FOREST_CATEGORICAL}
    for column, level, n, positive in counts.collect():
        found[column][level] = (n, positive)
    labels = [sorted(found[c]) for c in FOREST_CATEGORICAL]
    rows = sum(n for n, _ in found["route_id"].values())
    late = sum(positive for _, positive in found["route_id"].values())
    if not 0 < late < rows:
        raise ValueError("class weights need both classes")
    prior = late / rows

    fill = _select({f"{c}_level": sql for c, sql in filled.items()})
    indexer = StringIndexerModel.from_arrays_of_labels(
        labels,
        inputCols=[f"{c}_level" for c in FOREST_CATEGORICAL],
        outputCols=[f"{c}_index" for c in FOREST_CATEGORICAL],
        handleInvalid="keep",
    )
    columns = {}
    for name, known in zip(FOREST_CATEGORICAL, labels, strict=True):
        index = f"cast(`{name}_index` as int)"
        if name in S.TARGET_ENCODED:
            numbers = []
            for level in known:
                n, positive = found[name][level]
                weight = encoding.own_weight(n, settings.smoothing, settings.min_rows)
                numbers.append(repr(prior * (1 - weight) + positive / n * weight))
            listed = ",".join(numbers)
            columns[f"{name}_value"] = (
                f"coalesce(get(cast(split('{listed}', ',') as array<double>), {index}), {_literal(prior)})"
            )
        else:
            columns[f"{name}_value"] = f"cast(if({index} < {len(known)}, {index}, -1) as double)"
    medians = encoding.fit_medians(train, S.PROCESSED_NUMERIC)
    for c in S.PROCESSED_NUMERIC:
        columns[f"{c}_value"] = f"coalesce(cast(`{c}` as double), {_literal(medians.get(c, 0.0))})"
    names = [f"{c}_value" for c in FOREST_CATEGORICAL + S.PROCESSED_NUMERIC]
    stages = [fill, indexer, _select(columns), VectorAssembler(inputCols=names, outputCol="features")]
    return stages, {0: rows / (2.0 * (rows - late)), 1: rows / (2.0 * late)}


def fit_forest(train: DataFrame, label: str = "label", settings: ForestSettings | None = None) -> PipelineModel:
    settings = settings or ForestSettings()
    stages, weights = forest_stages(train, label, settings)
    rows = weighted_vectors(stages, train, label, weights)
    share = settings.max_samples or 0
    rate = rows_per_tree(settings.max_samples, 1 if share <= 1 else train.count())
    if settings.hand_over:
        size = len(stages[-1].getInputCols())
        tried = forest.tried_number(feature_subset(settings.max_features), size)
        model = forest.fit(
            rows, label, (weights[0], weights[1]), settings.trees, settings.max_depth, settings.min_leaf,
            tried, rate, settings.seed, settings.max_bins, settings.hand_over,
        )
        return PipelineModel([*stages, model])
    model = RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol="class_weight",
        numTrees=settings.trees, maxDepth=settings.max_depth, minInstancesPerNode=settings.min_leaf,
        featureSubsetStrategy=feature_subset(settings.max_features), subsamplingRate=rate,
        bootstrap=True, seed=settings.seed, maxMemoryInMB=settings.memory_mb, cacheNodeIds=False,
        maxBins=settings.max_bins,
    ).fit(rows)
    return PipelineModel([*stages, model])


def feature_importances(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Impurity-based importance per feature, largest first."""
    names = [c.removesuffix("_value") for c in model.stages[-2].getInputCols()]
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(names, values, strict=True))
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


# ---- scoring ---------------------------------------------------------------


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """An error naming the model inputs that ``df`` does not have; reads no data."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def with_probability(model: Model, df: DataFrame) -> DataFrame:
    """Input columns plus the probability of delay."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else None
    if isinstance(last, RandomForestClassificationModel) and last.numClasses == 2:
        vectors = PipelineModel(model.stages[:-1]).transform(df)
        late = forest.probability(df.sparkSession, last)
        return vectors.select(*df.columns, late.alias("pred_proba_delayed"))
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias("pred_proba_delayed"))


def label_at(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("pred_label", (F.col("pred_proba_delayed") >= threshold).cast("int"))


def score(
    model: Model, df: DataFrame, threshold: float = 0.5, columns: Sequence[str] = ()
) -> DataFrame:
    """Batch scoring: input columns, probability, label at the threshold."""
    require_columns(df, columns)
    return label_at(with_probability(model, df), threshold)


def evaluation_table(model: Model, df: DataFrame, label: str, argmax: bool = False) -> DataFrame:
    """Rows with truth, prediction and probability.

    ``argmax`` leaves a probability of exactly one half in class 0, otherwise it is class 1.
    """
    p = F.col("pred_proba_delayed")
    predicted = (p > 0.5) if argmax else (p >= 0.5)
    return with_probability(model, df).select(
        *df.columns,
        F.col(label).cast("int").alias("y_true"),
        predicted.cast("int").alias("y_pred"),
        p.alias("y_proba"),
    )


@dataclass
class FittedModel:
    """A pipeline and the columns it reads."""

    pipeline: PipelineModel
    columns: list[str] = field(default_factory=list)

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        names = spark.createDataFrame([(c,) for c in self.columns], "value string")
        names.coalesce(1).write.mode("overwrite").text(f"{path}/columns")

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedModel:
        columns = [row["value"] for row in spark.read.text(f"{path}/columns").collect()]
        return FittedModel(PipelineModel.load(f"{path}/pipeline"), columns)

    def score(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return score(self.pipeline, df, threshold, self.columns)
