"""CSV, JSON and text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators.metrics import classification_report

REPORT_NAMES = ("not_delayed", "delayed")


def save_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with headers, one per task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_json(one_row: DataFrame, path: str) -> None:
    """Metrics and run summary as one JSON line."""
    one_row.coalesce(1).write.mode("overwrite").json(path)


def report_text(scored: DataFrame, ranking: DataFrame, title: str) -> DataFrame:
    """The classification report as numbered lines of text; both inputs have fixed, few rows."""
    report = classification_report(scored, REPORT_NAMES)
    names = [*REPORT_NAMES, "accuracy", "macro avg", "weighted avg"]
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("row"))
    number = "%10.4f"
    lines = report.select(
        position.alias("line"),
        F.when(
            F.col("row") == "accuracy",
            F.format_string(f"%12s {' ' * 10}{' ' * 10}{number}%10d", "row", "f1_score", "support"),
        )
        .otherwise(
            F.format_string(f"%12s {number * 3}%10d", "row", "precision", "recall", "f1_score", "support")
        )
        .alias("value"),
    )
    head = "%12s %10s%10s%10s%10s" % ("", "precision", "recall", "f1-score", "support")
    extra = report.sparkSession.createDataFrame([(-1, f"=== {title} ==="), (0, head)], "line int, value string")
    scores = ranking.select(
        F.inline(
            F.array(
                F.struct(F.lit(8).alias("line"), F.format_string("ROC-AUC: %.4f", "roc_auc").alias("value")),
                F.struct(
                    F.lit(9).alias("line"),
                    F.format_string("PR-AUC: %.4f", "average_precision").alias("value"),
                ),
            )
        )
    )
    return extra.unionByName(lines.withColumn("line", F.col("line").cast("int"))).unionByName(scores)


def save_text(lines: DataFrame, path: str) -> None:
    """Numbered lines written in order as one small file."""
    lines.repartition(1).sortWithinPartitions("line").select("value").write.mode("overwrite").text(path)


def summary_text(report: DataFrame, scores: dict[str, float | None]) -> DataFrame:
    """A saved report followed by the scores of the run summary."""
    rows = [(10_000, ""), (10_001, "=== Summary ===")]
    rows += [(10_002 + i, f"{name}: {value}") for i, (name, value) in enumerate(scores.items())]
    return report.unionByName(report.sparkSession.createDataFrame(rows, "line int, value string"))
