"""The processed table: built once from the integrated CSV files, month by month kept up to date.

Beside the table lies a manifest: which file, of which length and time, gave how many rows to which
month. A file that is new, changed or gone costs its own months only; all others stay as they are.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schema as S
from headway.operators.features import processed_table
from headway.session import lookup_join, materialise
from headway.sources.arrivals import read_integrated

MANIFEST = "name string, length long, modified timestamp, service_month string, n long"


def write_by_month(df: DataFrame, path: str, replace_all: bool = True) -> None:
    """Parquet partitioned by month, so that date splits read only their months.

    The rebalance hint sizes the files at run time and cuts a month that holds a
    large part of the rows into several tasks. ``replace_all=False`` replaces only
    the months that ``df`` has rows of.
    """
    monthly = df.withColumn("service_month", F.date_format("service_date", "yyyy-MM"))
    (
        monthly.hint("rebalance", F.col("service_month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .option("compression", "snappy")
        .partitionBy("service_month")
        .parquet(path)
    )


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """Name, path, length and modification time of the CSV files; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .load(path)
        .select(F.input_file_name().alias("name"), "path", "length", F.col("modificationTime").alias("modified"))
    )


def _present(spark: SparkSession, path: str, pattern: str) -> bool:
    """Whether a folder holds files of the pattern."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    try:
        return files.load(path).select("path").first() is not None
    except AnalysisException:
        return False


def _arguments(spark: SparkSession, cache: str) -> str | None:
    """What the cache was built with; None if it does not say."""
    try:
        row = spark.read.text(f"{cache}/_arguments").first()
    except AnalysisException:
        return None
    return row[0] if row else None


def manifest(spark: SparkSession, cache: str) -> DataFrame | None:
    """Rows per source file and month; a file without valid rows has one row with ``n`` 0. None if absent."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{cache}/_manifest")
    except AnalysisException:
        return None


def _staged(spark: SparkSession, paths: list[str], tolerance: float, clipped_delay: bool) -> DataFrame:
    """The processed rows of some files with the file of each, written once: counts and table read them."""
    rows = processed_table(read_integrated(spark, paths), tolerance, clipped_delay)
    # every step up to here is row by row, so the name is that of the row's own file
    return materialise(rows.withColumn("_file", F.input_file_name()), "processed")


def _listed(files: DataFrame, staged: DataFrame) -> DataFrame:
    """Manifest rows of the files from their staged rows."""
    counts = staged.groupBy(
        F.col("_file").alias("name"), F.date_format("service_date", "yyyy-MM").alias("service_month")
    ).agg(F.count(F.lit(1)).alias("n"))
    return lookup_join(files.select("name", "length", "modified"), counts, ["name"]).fillna({"n": 0})


def _write_beside(df: DataFrame, path: str) -> None:
    # through the shared folder: a table can't be read and overwritten in one job
    materialise(df, "manifest").write.mode("overwrite").parquet(path)


def _drop_months(spark: SparkSession, cache: str, months: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for month in months:
        folder = jvm.org.apache.hadoop.fs.Path(f"{cache}/service_month={month}")
        folder.getFileSystem(conf).delete(folder, True)


def _build(spark: SparkSession, files: DataFrame, cache: str, tolerance: float, clipped_delay: bool) -> None:
    paths = [r["path"] for r in files.select("path").collect()]
    staged = _staged(spark, paths, tolerance, clipped_delay)
    write_by_month(staged.drop("_file"), cache)
    _write_beside(_listed(files, staged), f"{cache}/_manifest")


def _update(
    spark: SparkSession, files: DataFrame, known: DataFrame, cache: str, tolerance: float, clipped_delay: bool
) -> None:
    """Rebuilds the months of new, changed and lost files from all files that have rows of them.

    The manifest is written last, so an update that was cut short is done again. Rows without a
    month are a month of their own.
    """
    marks = ["name", "length", "modified"]
    changed = files.join(known.select(*marks).distinct(), marks, "left_anti")
    stale = known.join(files, marks, "left_anti")
    paths = [r["path"] for r in changed.select("path").collect()]
    if not paths and stale.isEmpty():
        return
    kept = materialise(known.join(files.select(*marks), marks, "left_semi"), "manifest")
    listed, parts = kept, []
    months = stale.where("n > 0").select("service_month")
    if paths:
        parts.append(_staged(spark, paths, tolerance, clipped_delay))
        fresh = materialise(_listed(changed, parts[0]), "manifest")
        listed = kept.unionByName(fresh)
        months = months.unionByName(fresh.where("n > 0").select("service_month"))
    months = materialise(months.distinct(), "months")
    same = F.col("service_month").eqNullSafe(F.col("_month"))
    wanted = F.broadcast(months.select(F.col("service_month").alias("_month")))  # a row per month
    beside = kept.where("n > 0").join(wanted, same, "left_semi").select("name").distinct()
    others = [r["path"] for r in files.join(beside, "name", "left_semi").select("path").collect()]
    if others:
        staged = _staged(spark, others, tolerance, clipped_delay)
        monthly = staged.withColumn("service_month", F.date_format("service_date", "yyyy-MM"))
        parts.append(monthly.join(wanted, same, "left_semi").drop("service_month"))
    for i, part in enumerate(parts):
        rows = part if i == 0 else rows.unionByName(part)
    if parts:
        write_by_month(rows.drop("_file"), cache, replace_all=False)
    empty = months.join(
        listed.where("n > 0").select(F.col("service_month").alias("_month")).distinct(), same, "left_anti"
    )
    nameless = "__HIVE_DEFAULT_PARTITION__"
    _drop_months(spark, cache, [r["service_month"] or nameless for r in empty.collect()])
    _write_beside(listed, f"{cache}/_manifest")


def load_or_build(
    spark: SparkSession,
    source: str,
    cache: str,
    tolerance: float = S.TOLERANCE_SECONDS,
    rebuild: bool = False,
    clipped_delay: bool = False,
) -> DataFrame:
    """The processed table of ``source``, brought up to date; one built with other arguments is built again."""
    arguments = f"tolerance={float(tolerance)} clipped_delay={clipped_delay}"
    files = materialise(source_files(spark, source), "files")
    if files.isEmpty():
        raise FileNotFoundError(f"no CSV files under {source}")
    known = manifest(spark, cache)
    if rebuild or known is None or _arguments(spark, cache) != arguments:
        _build(spark, files, cache, tolerance, clipped_delay)
        said = spark.createDataFrame([(arguments,)], "value string")
        said.coalesce(1).write.mode("overwrite").text(f"{cache}/_arguments")
    else:
        _update(spark, files, known, cache, tolerance, clipped_delay)
    # the month is text, not a date, also when read back
    return spark.read.option("basePath", cache).parquet(cache).withColumn(
        "service_month", F.col("service_month").cast("string")
    )


def load_or_build_sample(spark: SparkSession, build, cache: str, rebuild: bool = False) -> DataFrame:
    """A sampled table kept as Parquet; ``build`` makes it when it is absent."""
    if not rebuild and _present(spark, cache, "*.parquet"):
        return spark.read.parquet(cache)
    build().write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)
