"""Row comparison of a Spark result with the DuckDB result of its SQL twin."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, 0.0) if v == 0 else (1, v)
    return (1, v) if isinstance(v, int) else (2, str(v))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_value(r[i]) for i in order) for r in rows), key=repr
    )


def difference(df, con, sql: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    answer = con.execute(sql)
    want_names, want = rows_of([c[0] for c in answer.description], answer.fetchall())
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want_names != got_names:
        return f"columns {got_names} instead of {want_names}"
    if len(want) != len(got):
        return f"{len(got)} rows instead of {len(want)}"
    for a, b in zip(got, want, strict=True):
        for name, x, y in zip(got_names, a, b, strict=True):
            same = x == y or (
                isinstance(x[1], float) and isinstance(y[1], float) and math.isclose(x[1], y[1], abs_tol=2e-12)
            )
            if not same or type(x[1]) is not type(y[1]):
                return f"{name}: {x[1]!r} instead of {y[1]!r} in {a} against {b}"
    return None
