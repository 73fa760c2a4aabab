"""Session settings, shared storage for intermediate tables, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A lookup table is broadcast only when it is within both limits.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024

SALTS = 32
# A key with more rows than this is spread over ``SALTS`` tasks of a shuffled join.
HOT_ROWS = 100_000


def get_session(app_name: str = "headway", master: str | None = None, **settings) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    tune(spark)
    return spark


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster that place must exist on every node, or the package be installed there.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def tune(spark: SparkSession) -> None:
    """Settings that may be changed on a running session.

    The JVM never compiles a method above 8000 bytes of bytecode, and a wide feature
    stage can exceed that. With this limit Spark splits such a stage into small
    methods instead of running one large one interpreted.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    ship_code(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a temporary one only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="headway-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


# Paths of the tables written inside the open ``intermediates`` blocks, innermost last.
_owned: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside the block are deleted at its end, kept ones excepted.

    A result that still reads them must be written, or collected, inside the block.
    """
    _owned.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _owned.pop():
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def own(path: str) -> None:
    """Leave a folder in the shared storage to the enclosing ``intermediates`` block, if there is one."""
    if _owned:
        _owned[-1].append(path)


def materialise(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    Cuts the lineage, survives the loss of executors, keeps column pruning, and
    makes a later ``count()`` a footer read. An enclosing ``intermediates`` block
    deletes the table at its end unless it is to be kept.
    """
    path = f"{shared_folder(df.sparkSession)}/headway/{label}-{uuid.uuid4().hex}"
    if not keep:
        own(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_table(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """``df`` as a driver-local table when its measured size is within the limits, else None."""
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > BROADCAST_BYTES:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a large table to a lookup table.

    A lookup within the broadcast limits needs no shuffle of the facts. Beyond
    them both sides are shuffled, and one hot key is spread over ``SALTS`` tasks
    instead of one.
    """
    local = small_table(table, max_rows)
    if local is not None:
        return facts.join(F.broadcast(local), keys, how)
    return salted_join(facts, table, keys, how)


def salted_join(
    facts: DataFrame, table: DataFrame, keys: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Shuffled join in which the rows of a key with many facts, or of a null one, are spread by a salt.

    Only rows of the table that meet such a key are copied; the join never broadcasts the copies,
    whose size Spark would estimate as that of the table.
    """
    frequent = F.count(F.lit(1)) > F.lit(HOT_ROWS)
    counted = facts.dropna(subset=keys).groupBy(*keys).agg(frequent.alias("_hot")).where("_hot")
    hot = F.broadcast(materialise(counted, "hot-keys"))  # one key in HOT_ROWS rows at most
    # The salt is a hash of the row, not a random number: a recomputed task must
    # send each row to the same place as before.
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(salts)).cast("int")
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = facts.join(hot, keys, "left").withColumn("_salt", F.when(F.col("_hot") | missing, salt).otherwise(0))
    last = F.when(F.col("_hot"), salts - 1).otherwise(0)
    copies = table.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
    joined = spread.drop("_hot").join(copies.drop("_hot").hint("merge"), [*keys, "_salt"], how)
    return joined.drop("_salt")
