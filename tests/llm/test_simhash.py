import random

import cases
import numpy as np
import pytest
import xxhash

from headway.llm import simhash
from headway.llm.components import components


class Groups:
    """Union-find over any keys."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute_print(text, k=4):
    fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = fold.translate({c: " " for c in (9, 10, 11, 12, 13)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    values = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def test_fingerprints_as_brute_force(spark):
    docs = cases.documents(spark)
    texts = {(r.doc_id, r.h): r.text for r in docs.selectExpr("doc_id", "xxhash64(text) h", "text").collect()}
    for r in simhash.fingerprints(docs).collect():
        assert r.fp % (1 << 64) == brute_print(texts[r.doc_id, r.h])


def test_components_as_brute_force(spark):
    docs = cases.clashing(cases.documents(spark))
    rows = [(r.doc_id, brute_print(r.text)) for r in docs.collect()]
    groups = Groups()
    for i, (_, a) in enumerate(rows):
        for j in range(i):
            if (a ^ rows[j][1]).bit_count() <= 4:
                groups.join(i, j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            best[groups.find(i)] = min(doc_id, best.get(groups.find(i), doc_id))
    want = sorted(((d, best.get(groups.find(i))) for i, (d, _) in enumerate(rows)), key=repr)
    assert cases.rows_of(simhash.near_duplicates(docs).select("doc_id", "component_id")) == want


def cloud(rng, n, spread, centre):
    return {centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, spread))) for _ in range(n)}


@pytest.mark.parametrize("cell,crowd", [(64, 16384), (2, 16384), (2, 4)])
@pytest.mark.parametrize("distance", [4, 3])
def test_links_connect_as_brute_force(spark, cell, crowd, distance):
    rng = random.Random(8)
    values = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for _ in range(3):
        values |= cloud(rng, 25, 5, rng.getrandbits(64))
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(
        spark.createDataFrame([(v,) for v in values], "fp long"), distance, cell=cell, crowd=crowd
    ).collect()
    mine, want = Groups(), Groups()
    for a, b in found:
        assert ((a ^ b) % (1 << 64)).bit_count() <= distance
        mine.join(a, b)
    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) % (1 << 64)).bit_count() <= distance:
                want.join(a, b)
    assert {v: mine.find(v) for v in values} == {v: want.find(v) for v in values}


def test_spanning_links_are_fewer_than_members():
    rng = random.Random(1)
    values = np.array(sorted(cloud(rng, 300, 3, rng.getrandbits(64))), dtype=np.uint64)
    a, b = simhash.spanning_links(values, 4)
    assert len(a) < len(values)
    assert (np.bitwise_count((a ^ b).view(np.uint64)) <= 4).all()


def test_radii_miss_no_pair():
    for distance in range(9):
        for segments in (1, 2, 3, 4):
            radii = [r for _, _, r in simhash._segments(distance, segments)]
            assert sum(r + 1 for r in radii) > distance


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    for nodes, edges in ((30, 20), (60, 200), (50, 49)):
        pairs = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(edges)]
        if edges == 49:
            pairs = [(i, i + 1) for i in range(49)]  # a path
        groups = Groups()
        for a, b in pairs:
            groups.join(a, b)
        linked = {x for a, b in pairs if a != b for x in (a, b)}
        got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert got == {x: groups.find(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_component_stays(spark):
    docs = cases.clashing(cases.documents(spark))
    out = simhash.deduplicated(docs)
    assert out.columns == docs.columns
    prints, groups = {brute_print(r.text) for r in docs.collect()}, Groups()
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 4:
                groups.join(a, b)
    assert sorted(groups.find(brute_print(r.text)) for r in out.collect()) == sorted(
        {groups.find(a) for a in prints}
    )
    ids = [r.doc_id for r in out.collect() if r.doc_id is not None]
    assert ids.count(1005) == 1 and ids.count(1006) == 2
    assert simhash.deduplicated(docs.limit(0)).count() == 0
