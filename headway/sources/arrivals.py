"""CSV sources: raw arrivals, hourly weather, clean and integrated tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway import schema as S

# fixed values: types of the raw weather columns; any other column is text
WEATHER_TYPES = {
    "year": T.IntegerType(),
    "month": T.IntegerType(),
    "day": T.IntegerType(),
    "hour": T.IntegerType(),
    "coco": T.IntegerType(),
    "temp": T.DoubleType(),
    "rhum": T.DoubleType(),
    "prcp": T.DoubleType(),
    "wdir": T.DoubleType(),
    "wspd": T.DoubleType(),
    "pres": T.DoubleType(),
    "cldc": T.DoubleType(),
    "wpgt": T.DoubleType(),
}


def list_csv(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Sorted paths of the ``.csv`` files under ``path``; an error if there are none."""
    files = spark.read.schema("value string").csv(path, pathGlobFilter="*.csv").inputFiles()
    if not files:
        raise FileNotFoundError(f"no CSV files under {path}")
    return sorted(unquote(f) for f in files)  # names come as URIs, paths are read as they are


def read_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The CSV files of a file, folder or list of files with every column as text.

    Files may order or choose their columns differently: those of one header are read
    together, and the groups are matched by column name.
    """
    headers: dict[tuple[str, ...], list[str]] = {}
    for file in list_csv(spark, path):
        names = tuple(spark.read.option("header", True).csv(file).columns)
        headers.setdefault(names, []).append(file)
    return union_by_name(
        [
            spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
            .option("header", True)
            .csv(files)
            for names, files in headers.items()
        ]
    )


def _typed(column: str, dtype: T.DataType) -> Column:
    """Text as a value of the type; null if it is none. Whole numbers may be written as 8.0."""
    value = F.trim(F.col(f"`{column}`"))
    if isinstance(dtype, T.IntegralType):
        number = value.try_cast("double")
        return F.when(number == F.floor(number), number.try_cast(dtype))
    return F.col(f"`{column}`") if isinstance(dtype, T.StringType) else value.try_cast(dtype)


def typed(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Text columns converted to the types stated for them, others as they are."""
    return df.withColumns({c: _typed(c, t) for c, t in types.items() if c in df.columns})


def unreadable(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Per column the number of non-empty texts that are no value of the stated type, in one pass."""
    known = [c for c in types if c in df.columns]
    lost = [
        F.count_if((F.trim(F.col(f"`{c}`")) != "") & _typed(c, types[c]).isNull()).alias(c) for c in known
    ]
    parts = ", ".join(f"'{c}', `{c}`" for c in known)
    return df.agg(*lost).select(F.expr(f"stack({len(known)}, {parts}) as (column, n_unreadable)"))


def read_csv(spark: SparkSession, path: str | list[str], types: dict[str, T.DataType]) -> DataFrame:
    """CSV files typed by column name, read as text and then converted.

    Types are declared rather than inferred: inference needs a pass over the data and may
    read the same identifier as a number in one file and as text in the next. What cannot
    be converted is null; ``unreadable`` counts it.
    """
    return typed(read_text(spark, path), types)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_arrivals(spark: SparkSession, *folders: str) -> DataFrame:
    """Raw arrivals of every CSV file in the folders, e.g. one folder per year."""
    types = {f.name: f.dataType for f in S.RAW_ARRIVAL_SCHEMA}
    return union_by_name([read_csv(spark, folder, types) for folder in folders])


def read_conditions(spark: SparkSession, *paths: str) -> DataFrame:
    """Raw hourly weather, e.g. one file per year."""
    return union_by_name([read_csv(spark, path, WEATHER_TYPES) for path in paths])


def read_clean_arrivals(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, {f.name: f.dataType for f in S.CLEAN_ARRIVAL_SCHEMA})


def read_integrated(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Arrivals with weather; the identifier columns are text whatever they look like."""
    return read_csv(spark, path, {f.name: f.dataType for f in S.INTEGRATED_SCHEMA})
