"""Registration of queries together with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.plans.oracle import with_tables
from headway.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Result columns as BIGINT, DOUBLE rounded to six digits, or text."""
    columns = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegralType, T.BooleanType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FractionalType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(sql: str | None = None, tables: tuple[str, ...] = (), name: str | None = None):
    """Register a function as a query; its name is the query's name."""

    def register(build: Query) -> Query:
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return plain(build(spark, folder))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_tables(sql, tables)
        return build

    return register
