"""From raw documents to shards: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.llm import contamination, mixing, quality, sharding, simhash
from headway.session import intermediates, materialise

SHARDS = 24

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classified(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents the quality classifier keeps."""
    return quality.good_documents(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def deduplicated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of SimHash near duplicates."""
    return simhash.deduplicated(docs, shingle=4, distance=4)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return contamination.decontaminated(docs, spark.read.parquet(f"{folder}/benchmark.parquet"), window=10)


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix by source weights takes them."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharding.shard_rows(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classified),
    ("SimHash near-dedup", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

# A language model and XXH64 fingerprints are beyond SQL; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each result is written and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with intermediates(spark):  # what a stage wrote for itself goes when its result is written
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-").lower(), keep=True)
    return docs
