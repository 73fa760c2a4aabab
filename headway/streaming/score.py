"""Scoring files as they arrive: each file is scored once, in batches bounded by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from headway.operators.models import FittedModel


def read_new_files(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def score_new_files(
    model: FittedModel, rows: DataFrame, output: str, checkpoint: str, threshold: float = 0.5
) -> StreamingQuery:
    """Score everything that has arrived since the last run, then stop."""
    return (
        model.score(rows, threshold)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
