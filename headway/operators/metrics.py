"""Exact evaluation of binary scores.

Input tables have ``y_true`` (0/1), ``y_pred`` (0/1) and ``y_proba``. Everything
that needs an order works on counts per distinct score, see ``ranking``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import numeric
from headway.operators.ranking import running_totals
from headway.session import materialise


def cell(truth: int, predicted: int) -> Column:
    return F.count_if((F.col("y_true") == truth) & (F.col("y_pred") == predicted))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 for an empty whole."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def overall(df: DataFrame) -> DataFrame:
    """Accuracy, support, positive rate and Brier score in one pass."""
    return df.agg(
        F.avg((F.col("y_true") == F.col("y_pred")).cast("int")).alias("accuracy"),
        F.count(F.lit(1)).alias("support"),
        F.avg("y_true").alias("positive_rate"),
        F.avg(F.pow(F.col("y_proba") - F.col("y_true"), F.lit(2.0))).alias("brier_score"),
    )


def cells(df: DataFrame) -> DataFrame:
    return df.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Two rows, truth by prediction; zero cells are kept."""
    return cells(df).select(
        F.expr("stack(2, 0, tn, fp, 1, fn, tp) as (y_true, predicted_0, predicted_1)")
    )


def classification_report(df: DataFrame, names: Sequence[str] = ("0", "1")) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    per_class = cells(df).select(
        (tn + fp).alias("s0"),
        (fn + tp).alias("s1"),
        ratio(tn, tn + fn).alias("p0"),
        ratio(tn, tn + fp).alias("r0"),
        ratio(2 * tn, 2 * tn + fp + fn).alias("f0"),
        ratio(tp, tp + fp).alias("p1"),
        ratio(tp, tp + fn).alias("r1"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tn + tp, tn + fp + fn + tp).alias("acc"),
    )

    def row(name: str, *values: Column) -> Column:
        fields = ("precision", "recall", "f1_score", "support")
        return F.struct(
            F.lit(name).alias("row"), *[v.alias(f) for v, f in zip(values, fields, strict=True)]
        )

    s0, s1 = F.col("s0"), F.col("s1")
    macro = [(F.col(f"{m}0") + F.col(f"{m}1")) / 2 for m in "prf"]
    weighted = [ratio(F.col(f"{m}0") * s0 + F.col(f"{m}1") * s1, s0 + s1) for m in "prf"]
    rows = F.array(
        row(names[0], F.col("p0"), F.col("r0"), F.col("f0"), s0),
        row(names[1], F.col("p1"), F.col("r1"), F.col("f1"), s1),
        row("accuracy", F.col("acc"), F.col("acc"), F.col("acc"), s0 + s1),
        row("macro avg", *macro, s0 + s1),
        row("weighted avg", *weighted, s0 + s1),
    )
    return per_class.select(F.inline(rows))


def threshold_counts(df: DataFrame) -> DataFrame:
    """Per distinct score, from the highest: positives and negatives at it and down to it."""
    counted = (
        df.where(F.col("y_proba").isNotNull() & ~F.isnan("y_proba"))
        .groupBy(F.col("y_proba").alias("threshold"))
        .agg(
            F.count_if(F.col("y_true") == 1).alias("pos"),
            F.count_if(F.col("y_true") == 0).alias("neg"),
        )
    )
    counted = materialise(counted, "counted")
    return running_totals(counted, "threshold", ["pos", "neg"], descending=True).withColumnsRenamed(
        {"pos_upto": "tp", "neg_upto": "fp"}
    )


def ranking_scores(df: DataFrame) -> DataFrame:
    """ROC-AUC (a tie counts half) and average precision, null when a class is absent."""
    table = threshold_counts(df)
    positives, negatives = F.col("pos_total"), F.col("neg_total")
    above = F.col("tp") - F.col("pos") / F.lit(2.0)
    return table.agg(
        F.sum(
            F.when((positives > 0) & (negatives > 0), F.col("neg") * above / positives / negatives)
        ).alias("roc_auc"),
        F.sum(
            F.when(
                positives > 0,
                F.col("pos") / positives * F.col("tp") / (F.col("tp") + F.col("fp")),
            )
        ).alias("average_precision"),
    )


def _point(df: DataFrame, **values: float | None) -> DataFrame:
    columns = [F.lit(v).cast("double").alias(k) for k, v in values.items()]
    return df.sparkSession.range(1).select(*columns)


def roc_curve(df: DataFrame) -> DataFrame:
    """One point per distinct score, and (0, 0) at threshold infinity; the rate of an absent class is null."""
    points = threshold_counts(df).select(
        F.col("threshold").cast("double").alias("threshold"),
        F.try_divide("fp", "neg_total").alias("fpr"),
        F.try_divide("tp", "pos_total").alias("tpr"),
    )
    return points.unionByName(_point(df, threshold=float("inf"), fpr=0.0, tpr=0.0))


def precision_recall_curve(df: DataFrame) -> DataFrame:
    """One point per distinct score, and recall 0 with precision 1, which has no threshold.

    Without positive rows the recall of the scores is null.
    """
    points = threshold_counts(df).select(
        F.col("threshold").cast("double").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "pos_total").alias("recall"),
    )
    return points.unionByName(_point(df, threshold=None, precision=1.0, recall=0.0))


def calibration(df: DataFrame, bins: int = 10) -> DataFrame:
    """Mean predicted and observed rate of equal-width score bins; empty bins are absent."""
    edges = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    return (
        df.withColumn("bin", numeric.right_closed_bin(F.col("y_proba"), edges))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(
            F.avg("y_proba").alias("mean_predicted"),
            F.avg("y_true").alias("observed_rate"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def slice_rates(df: DataFrame, column: str) -> DataFrame:
    """Support and rates per value of a column."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(
            F.count(F.lit(1)).alias("support"),
            F.avg("y_true").alias("positive_rate"),
            F.avg("y_pred").alias("predicted_positive"),
            F.avg("y_proba").alias("avg_proba"),
        )
    )


def slice_precision_recall(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Precision and recall per bucket; buckets where one of them is undefined are left out."""
    table = (
        df.withColumn("bucket", numeric.right_closed_bin(F.col(column), edges))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("support"),
            cell(1, 1).alias("tp"),
            cell(0, 1).alias("fp"),
            cell(1, 0).alias("fn"),
            F.avg("y_true").alias("positive_rate"),
        )
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return table.where((tp + fp > 0) & (tp + fn > 0)).select(
        "bucket",
        "support",
        (tp / (tp + fp)).alias("precision"),
        (tp / (tp + fn)).alias("recall"),
        "positive_rate",
    )


def evaluation(df: DataFrame) -> DataFrame:
    """All scalar metrics of a scored table in one row, the report and the matrix nested.

    The scores are written first: the model runs once, not once per metric.
    """
    df = materialise(df.select("y_true", "y_pred", "y_proba"), "scores")
    report = classification_report(df).agg(
        F.collect_list(F.struct("row", "precision", "recall", "f1_score", "support")).alias(
            "classification_report"
        )
    )
    matrix = cells(df).select(
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix")
    )
    one = F.lit(1).alias("_one")
    parts = [overall(df), ranking_scores(df), report, matrix]
    result = parts[0].select("*", one)
    for part in parts[1:]:
        result = result.join(F.broadcast(part.select("*", one)), "_one")
    return result.drop("_one")


