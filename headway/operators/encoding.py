"""Column transforms fitted on one split and applied to any.

Every fit returns a statistics table or a few numbers, every apply only reads
them, so nothing of the validation or test rows can leak into a fit.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import schema as S
from headway.operators.profiles import category_frequencies, long_form
from headway.operators.ranking import exact_quantiles, running_totals, top_values
from headway.session import lookup_join, materialise

# Levels of a categorical column that a model or an indexer may hold on the driver.
MAX_LEVELS = 1_000_000


class TooManyLevels(ValueError):
    """A column has more levels than a model on the driver may hold; ``wide_descent`` takes any number."""


def check_levels(df: DataFrame, columns: Sequence[str], limit: int = MAX_LEVELS) -> None:
    """An error when a column has more levels than a one-hot or indexed model may hold, counted exactly."""
    parts = ", ".join(f"'{c}', cast(`{c}` as string)" for c in columns)
    levels = df.select(F.expr(f"stack({len(columns)}, {parts}) as (column, level)")).distinct()
    sizes = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count("level").alias("n")).collect()}
    too_many = [c for c in columns if sizes.get(c, 0) > limit]
    if too_many:
        raise TooManyLevels(f"too many levels to index: {', '.join(too_many)}; bucket rare ones first")


# ---- numbers ---------------------------------------------------------------


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians, one number per column; columns without any value are absent.

    All columns are counted per value in one pass, combined before the shuffle.
    """
    table = exact_quantiles(long_form(train, columns), "value", {"median": 0.5}, ["column"])
    return {row["column"]: row["median"] for row in table.collect()}


def fill_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}
    )


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column gets deviation 1."""
    row = train.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    ).first()
    return {c: (row[f"{c}__mean"] or 0.0, row[f"{c}__std"] or 1.0) for c in columns}


def scaled(column: str, mean: float, deviation: float) -> Column:
    return (F.col(column) - F.lit(mean)) / F.lit(deviation)


def scale(df: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: scaled(c, *stats) for c, stats in scaling.items()})


# ---- categories ------------------------------------------------------------


def most_frequent(train: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The most frequent value of each column, found in one pass; of ties the smallest."""
    rows = category_frequencies(train, dict.fromkeys(columns, 1)).collect()
    return {row["column"]: row["value"] for row in rows}


def fill_most_frequent(train: DataFrame, columns: Sequence[str], *others: DataFrame) -> list[DataFrame]:
    values = most_frequent(train, columns)
    return [df.na.fill(values) for df in (train, *others)]


def fit_one_hot(train: DataFrame, columns: Sequence[str], limit: int | None = None):
    """Indexer and encoder; a level not seen in ``train``, or null, becomes the zero vector.

    The extra index the indexer keeps for such values is the one the encoder drops.
    """
    check_levels(train, columns, limit or MAX_LEVELS)
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    ).fit(train)
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_onehot" for c in columns],
        dropLast=True,
    ).fit(indexer.transform(train))
    return indexer, encoder


def ordinal_table(train: DataFrame, column: str) -> DataFrame:
    """Code of each level in sorted order, from 0."""
    levels = train.where(F.col(column).isNotNull()).select(column).distinct()
    levels = materialise(levels.withColumn("_one", F.lit(1).cast("long")), "levels")
    ranked = running_totals(levels, column, ["_one"])
    return ranked.select(column, (F.col("_one_upto") - 1).cast("int").alias(f"{column}_code"))


def apply_ordinal(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Codes joined on; -1 for a level without one, -2 for null."""
    code = F.col(f"{column}_code")
    return lookup_join(df, table, [column]).withColumn(
        f"{column}_code",
        F.when(F.col(column).isNull(), -2).otherwise(F.coalesce(code, F.lit(-1))),
    )


def blend_weight(n: Column, smoothing: float, min_rows: float) -> Column:
    """Weight of the level's own mean: an s-curve in the number of rows."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(float(min_rows))) / F.lit(float(smoothing))))


def own_weight(n: int, smoothing: float, min_rows: float) -> float:
    """``blend_weight`` of a number."""
    return 1.0 / (1.0 + math.exp(-(n - min_rows) / smoothing))


def target_table(
    train: DataFrame,
    column: str,
    label: str,
    smoothing: float = 10.0,
    min_rows: float = 20.0,
    method: str = "sigmoid",
    prior: float | None = None,
) -> tuple[DataFrame, float]:
    """Blend of level mean and overall mean per level, and the overall mean (``prior`` if known).

    ``sigmoid`` weighs the level mean by an s-curve of its row count; ``m_estimate``
    adds ``smoothing`` rows of the overall mean.
    """
    if prior is None:
        prior = train.agg(F.avg(label).cast("double")).first()[0]
    n, total = F.col("_n"), F.col("_sum")
    if method == "sigmoid":
        weight = blend_weight(n, smoothing, min_rows)
        encoding = F.lit(prior) * (1 - weight) + (total / n) * weight
    elif method == "m_estimate":
        encoding = (total + F.lit(smoothing * prior)) / (n + F.lit(float(smoothing)))
    else:
        raise ValueError(f"unknown target encoding {method}")
    table = (
        train.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(label).alias("_sum"))
        .select(column, encoding.alias(f"{column}_target"))
    )
    return table, prior


def apply_target(df: DataFrame, column: str, table: DataFrame, prior: float) -> DataFrame:
    """Encodings joined on; an unseen or null level gets the overall mean."""
    return lookup_join(df, table, [column]).withColumn(
        f"{column}_target", F.coalesce(F.col(f"{column}_target"), F.lit(prior))
    )


def frequent_values(train: DataFrame, column: str, n: int) -> list[str]:
    """The ``n`` most frequent values of the fit split."""
    return [row[column] for row in top_values(train, column, n).select(column).collect()]


def bucket_rare(df: DataFrame, column: str, frequent: Sequence[str], other: str = S.OTHER) -> DataFrame:
    """Values outside ``frequent``, and null, become ``other``."""
    kept = F.col(column).isin(list(frequent))
    return df.withColumn(column, F.when(kept, F.col(column)).otherwise(other))


def bucket_by_table(df: DataFrame, column: str, train: DataFrame, n: int) -> DataFrame:
    """As ``bucket_rare`` with a join to the table of frequent values, for any ``n``."""
    frequent = top_values(train, column, n).select(column, F.lit(True).alias("_frequent"))
    joined = lookup_join(df, frequent, [column])
    kept = F.coalesce(F.col("_frequent"), F.lit(False))
    return joined.withColumn(column, F.when(kept, F.col(column)).otherwise(S.OTHER)).select(*df.columns)


# ---- class weights ---------------------------------------------------------


def class_weights(df: DataFrame, label: str) -> dict[int, float]:
    """n / (2 * rows of the class) for the two classes."""
    counts = {row[label]: row["count"] for row in df.groupBy(label).count().collect()}
    if set(counts) != {0, 1}:
        raise ValueError("class weights need both classes")
    total = sum(counts.values())
    return {c: total / (2.0 * n) for c, n in counts.items()}


def add_class_weight(df: DataFrame, label: str, weights: dict[int, float], output: str = "class_weight"):
    return df.withColumn(output, F.when(F.col(label) == 1, weights[1]).otherwise(weights[0]))
