"""Splits by date, hold-outs, samples and their guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import schema as S
from headway.operators.ranking import mark_smallest, running_totals
from headway.session import materialise

# Sampling hash: the first hexadecimal digits of a digest of the key, the same in any SQL dialect.
HASH_DIGITS = 12
HASH_RANGE = 16**HASH_DIGITS

Keys = str | Sequence[str]


def split_label(day: Column, dates: Sequence[str] = S.SPLIT_DATES) -> Column:
    """train, val or test by half-open date ranges; null outside them."""
    start, train_end, val_end, test_end = [F.lit(d).cast("date") for d in dates]
    return (
        F.when((day >= start) & (day < train_end), "train")
        .when((day >= train_end) & (day < val_end), "val")
        .when((day >= val_end) & (day < test_end), "test")
    )


def dated_splits(df: DataFrame, dates: Sequence[str] = S.SPLIT_DATES) -> DataFrame:
    """One table with a ``split`` column; rows outside the dates are left out.

    The date range is also stated on the month partitions of the processed table,
    so the scan skips the other months.
    """
    day = F.col("service_date")
    out = df.where((day >= F.lit(dates[0]).cast("date")) & (day < F.lit(dates[-1]).cast("date")))
    if "service_month" in df.columns:
        out = out.where(F.col("service_month").between(dates[0][:7], dates[-1][:7]))
    return out.withColumn("split", split_label(day, dates))


def split_at(df: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """Rows before ``date`` and rows from it on."""
    day, cut = F.col("service_date"), F.lit(date).cast("date")
    return df.where(day < cut), df.where(day >= cut)


def sampling_hash(key: Keys, seed: int = 42) -> Column:
    """A number in [0, HASH_RANGE) that depends only on the seed and the key columns, of any type."""
    names = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def check_fraction(fraction: float) -> None:
    if not 0 < fraction <= 1:
        raise ValueError("the sample fraction must be within (0, 1]")


def fraction_sample(df: DataFrame, key: Keys, fraction: float, seed: int = 42) -> DataFrame:
    """A repeatable sample by key: a map-side filter, no shuffle, no random state."""
    check_fraction(fraction)
    if fraction == 1:
        return df
    return df.where(sampling_hash(key, seed) < int(fraction * HASH_RANGE))


def _hashed(df: DataFrame, key: Keys, seed: int) -> tuple[DataFrame, str]:
    """Column ``_hash``, and the name of a single column that breaks its ties."""
    if isinstance(key, str):
        return df.withColumn("_hash", sampling_hash(key, seed)), key
    parts = F.to_json(F.struct(*[F.col(c) for c in key]))
    return df.withColumns({"_hash": sampling_hash(key, seed), "_key_text": parts}), "_key_text"


def fixed_sample(df: DataFrame, key: Keys, rows: int, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` rows (or all of a smaller table), picked by the hash of a unique key.

    Rows of one key stay or go together, so repeated keys can leave fewer rows.
    """
    hashed, tie = _hashed(df, key, seed)
    return mark_smallest(hashed, "_hash", tie, "_in", rows=rows).where("_in").select(*df.columns)


def sampled(
    df: DataFrame, key: Keys, max_rows: int | None = None, fraction: float = 1.0, seed: int = 42
) -> DataFrame:
    """At most ``max_rows`` rows, then a fraction of them, both by the hash of the key."""
    if max_rows:
        df = fixed_sample(df, key, max_rows, seed)
    return fraction_sample(df, key, fraction, seed + 1)


def row_cap(df: DataFrame, rows: int, order: str) -> DataFrame:
    """The first ``rows`` rows in the order of a unique column; no cap if not positive.

    Only the column is sorted, over all tasks; the rows themselves are filtered. Nulls
    have no place in the order and are left out.
    """
    if rows <= 0:
        return df
    counted = df.where(F.col(order).isNotNull()).groupBy(order).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(materialise(counted, "counted"), order, ["_n"])
    last = ranked.where(F.col("_n_upto") <= rows).agg(F.max(order)).first()[0]
    return df.where(F.col(order) <= F.lit(last))


def stratified_holdout(
    df: DataFrame, label: str, key: Keys, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Adds ``is_test``: the same share of each class, exact to the rounded row; null is a class."""
    hashed, tie = _hashed(df, key, seed)
    return mark_smallest(hashed, "_hash", tie, "is_test", share=test_share, groups=[label]).select(
        *df.columns, "is_test"
    )


def split_sizes(df: DataFrame, label: str) -> DataFrame:
    """Rows and distinct labels per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(label).alias("n_classes")
    )


def check_splits(df: DataFrame, label: str, needed: Sequence[str] = ("train", "val", "test")) -> None:
    """An error unless every needed split has rows and those of the first have two classes."""
    found = {row["split"]: row for row in split_sizes(df, label).collect()}
    empty = [name for name in needed if name not in found]
    if empty:
        raise ValueError(f"empty split: {', '.join(empty)}; check the dates of the data")
    if found[needed[0]]["n_classes"] < 2:
        raise ValueError("training rows have a single class")


def training_rows(df: DataFrame, stage: int) -> DataFrame:
    """Stage 1 fits on train; stage 2 on train and validation together."""
    return df.where(F.col("split") == "train") if stage == 1 else df.where(
        F.col("split").isin("train", "val")
    )
