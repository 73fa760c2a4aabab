"""Small tables with the awkward cases every operator has to stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone cloud amber field lantern willow harbour copper meadow signal anchor violet thunder".split()


def prose(rng: random.Random, n: int) -> str:
    out, line = [], []
    for k in range(n):
        line.append(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]))
        if rng.random() < 0.15 or k == n - 1:
            out.append(" ".join(line).capitalize() + ".")
            line = []
    return " ".join(out)


def documents(spark, n: int = 60, seed: int = 1, awkward: bool = True):
    """Prose, copies, near copies; with ``awkward`` also nulls, empty and long texts, repeated rows."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(5, 120)), rng.choice(["en", "de"]), f"s{i % 4}", 0) for i in range(n)]
    rows += [(n + i, rows[i][1], "en", "s0", 0) for i in range(5)]
    rows += [(n + 10 + i, rows[i + 5][1] + " Coda.", "en", "s1", 0) for i in range(5)]
    if awkward:
        rows += [
            (1000, None, "en", "s0", None), (1001, "", "en", None, 0), (1002, " \n\t", None, "s1", 3),
            (None, rows[0][1], "en", "s0", 0), (None, "No id here at all, said the clerk.", None, None, 0),
            (None, None, None, None, None),
            (1003, "word " * 30_000, "en", "s2", 0), (1004, "Ünïcode 😀 ñandú　ideographic space. ﬁ ſ K", "xx", "ü", 0),
        ]
        rows += [(1005, "The same row twice over, and then once more.", "en", "s0", 0)] * 3
        rows += [(1006, "One id, first text of the two.", "en", "s3", 0), (1006, "One id, second text.", "en", "s3", 0)]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(docs):
    """The documents with further columns whose names the operators might use inside."""
    from pyspark.sql import functions as F

    names = ["row", "h", "_h", "_id", "fp", "span", "block", "n", "size", "start", "_row", "_part", "_number",
             "_place", "copies", "g", "spans", "component_id", "kept", "first", "a.b"]
    return docs.withColumns({name: F.lit(f"mine-{name}") for name in names})


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
