"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Rows get their number in the order of ``doc_id`` and row content. A Feistel network with
cycle walking permutes the numbers below the row count; the permuted number gives shard
(remainder) and slot (quotient). Counts per shard differ by one at most, and the row of
any shard and slot is found by the inverse permutation, without a table.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import small_batches
from headway.operators.ordering import numbered

ROUNDS = 6
MASK = 0xFFFFFFFF


def round_keys(seed: int) -> list[int]:
    return [(seed * 0x9E3779B1 + (k + 1) * 0x7FEB352D) & MASK for k in range(ROUNDS)]


def _mix(half: np.ndarray, key: int) -> np.ndarray:
    """A round function; its products stay below 2**63, so that any engine can compute it."""
    z = (half + key) & MASK
    for _ in range(2):
        z = ((z ^ (z >> 16)) * 0x45D9F3B) & MASK
    return z ^ (z >> 16)


def _pass(x: np.ndarray, side: int, keys: list[int], forward: bool) -> np.ndarray:
    left, right = x // side, x % side
    for key in keys if forward else reversed(keys):
        if forward:
            left, right = right, (left + _mix(right, key)) % side
        else:
            left, right = (right - _mix(left, key)) % side, left
    return left * side + right


def permute(numbers, rows: int, seed: int = 0, forward: bool = True) -> np.ndarray:
    """The permutation of 0 .. rows - 1, or its inverse.

    The network permutes a square of at least ``rows`` cells; a number that leaves the
    range walks on along its cycle until it returns, which keeps the map one to one.
    """
    out = np.asarray(numbers, dtype=np.int64).copy()
    side = isqrt(max(rows, 1) - 1) + 1
    keys = round_keys(seed)
    away = np.arange(len(out))
    while len(away):
        out[away] = _pass(out[away], side, keys, forward)
        away = away[out[away] >= rows]
    return out


def locate(number: int, rows: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a row number."""
    slot, shard = divmod(int(permute([number], rows, seed)[0]), shards)
    return shard, slot


def row_at(shard: int, slot: int, rows: int, shards: int, seed: int = 0) -> int:
    """The row number at a shard and slot."""
    return int(permute([slot * shards + shard], rows, seed, forward=False)[0])


def shard_rows(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """All rows with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    Columns of these names are replaced, all others stay. Null ids come first; rows of one
    id are ordered by a hash of the whole row, equal rows are interchangeable. An empty
    table stays empty.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    small_batches(rows)
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    columns = [F.col(f"`{c}`") for c in names]
    whole = rows.select(
        F.struct(*columns).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64(*columns).alias("_content")
    )
    table, count = numbered(whole, [F.col("_id"), F.col("_content")], "sharding")

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), count, seed))

    placed = table.withColumn("_place", place("_number"))
    shard = F.pmod("_place", F.lit(shards)).cast("int").alias("shard")
    return placed.select("row.*", shard, F.expr(f"_place div {shards}").alias("slot"))
