import hashlib
import zlib
from collections import defaultdict

import cases
import numpy as np
import pytest

from headway.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tagged(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    return sha("".join(tagged(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def by_hand(rows):
    sources = defaultdict(list)
    for r in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"]) if r["text"] is not None else None
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        sources[r["source"]].append((r["doc_id"], leaf(r, r["text"]), leaf(r, lowered if hit else r["text"])))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = levels([x[1] for x in sources[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for k, (doc_id, own, claimed) in enumerate(sources[s]):
            siblings, now = [], claimed
            for tree, at in ((trees[s], k), (top, place)):
                for level in tree[:-1]:
                    run = list(level[at - at % 16 : at - at % 16 + 16])
                    siblings += run[: at % 16] + run[at % 16 + 1 :]
                    run[at % 16] = now
                    now, at = sha("".join(run)), at // 16
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], sha("".join(siblings)), now, now == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels_", range(1, 9))
def test_addresses_are_a_permutation_and_subtrees_are_runs(levels_, monkeypatch):
    monkeypatch.setattr(merkle, "BITS", 1)
    monkeypatch.setattr(merkle, "ARITY", 2)
    every = [int(a) for d in range(levels_) for a in merkle.address(levels_, d, np.arange(1 << d))]
    assert sorted(every) == list(range(merkle.nodes_in(levels_)))
    high, at = merkle.heights(levels_), levels_
    assert sum(high) == levels_
    for height in high:  # every stored block is one run of addresses, in its own van Emde Boas order
        at -= height
        for root in range(1 << at):
            base = int(merkle.address(levels_, at, root))
            for d in range(height):
                for k in range(1 << d):
                    assert merkle.address(levels_, at + d, (root << d) + k) == base + merkle.address(height, d, k)


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (16, 17, 1), (300, 1, 40), (5000, 3)])
def test_against_brute_force(spark, sizes, tmp_path):
    rows = [(i * 7 % 9973 + 10_000 * s, f"Text {i % 50} OF {s}", "en", f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_merkle(spark, str(tmp_path))
    assert cases.rows_of(found) == by_hand([r.asDict() for r in df.collect()])


def test_many_sources(spark, tmp_path):
    rows = [(i, f"T{i}", None, f"ä{i % 700}" if i % 701 else None, None) for i in range(1500)]
    df = spark.createDataFrame(rows, cases.SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert cases.rows_of(queries.op13_merkle(spark, str(tmp_path))) == by_hand([r.asDict() for r in df.collect()])


def test_awkward_rows_and_clashing_columns(spark, tmp_path):
    docs = cases.documents(spark)
    cases.clashing(docs).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_merkle(spark, str(tmp_path))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert cases.rows_of(found) == by_hand([r.asDict() for r in docs.collect()])


def test_blocks_hold_every_node_once(spark):
    docs = cases.documents(spark)
    made = merkle.manifest(docs)
    blocks = made.blocks().collect()
    assert len({(b.tree, b.block) for b in blocks}) == len(blocks)
    held = sum(b.lowest for b in blocks if b.tree != merkle.ROOTS and b.height == merkle.levels_of(b.lowest))
    assert held <= docs.count()
    for b in blocks:
        block = merkle.Block(b.height, b.lowest, bytes(b.digests))
        lowest = [block.node(b.height - 1, k) for k in range(b.lowest)]
        assert merkle.Block.build(b.height, lowest).hex == block.hex


def test_no_rows(spark, tmp_path):
    cases.documents(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op13_merkle(spark, str(tmp_path)).count() == 0
