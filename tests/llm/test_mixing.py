import random
from collections import Counter

import cases
import numpy as np
import pytest

from headway.llm import mixing


def brute_targets(sizes, share=1.5, most=2.0):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    budget, free, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while True:
        rate = budget / sum(weights[i] for i in free)
        above = {i for i in free if weights[i] * rate > most * sizes[i]}
        for i in free:
            out[i] = min(weights[i] * rate, most * sizes[i])
        if not above:
            return out
        budget -= sum(most * sizes[i] for i in above)
        free -= above


@pytest.mark.parametrize("seed", range(5))
def test_targets(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(0, 10 ** rng.randint(1, 5)) for _ in range(rng.randint(1, 25))]
    weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights, 1.5, 2.0)
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got) == pytest.approx(1.5 * sum(sizes))


@pytest.mark.parametrize("block", [7, 64, 1024])
def test_mix_takes_the_targets(spark, block):
    docs = cases.clashing(cases.documents(spark, n=200))
    out = mixing.mix(docs, block=block).collect()
    assert len(out) == docs.count()
    taken, sizes, target = Counter(), Counter(), {}
    for r in out:
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.first + r.second == r.taken and r.first <= r.size
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, brute_targets([sizes[s] for s in names]), strict=True))
    for s in names:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-9
        assert all(r.source_size == sizes[s] for r in out if r.source == s)


def test_reruns_agree_for_any_partitioning(spark):
    docs = cases.documents(spark, n=100)
    names = ["doc_id", "source", "size", "taken"]
    one = cases.rows_of(mixing.mix(docs.coalesce(1), block=16).select(names))
    assert one == cases.rows_of(mixing.mix(docs.repartition(5), block=16).select(names))


def test_schedule_is_even_and_whole(spark):
    docs = cases.documents(spark, n=300, awkward=False)
    rows = mixing.sizes(docs)
    sources = mixing.sources_of(rows, mixing.WEIGHTS, 1.5, 2.0)
    plan = mixing.schedule(rows, sources, 8).orderBy("slot").collect()
    assert len({r.slot for r in plan}) == len(plan)
    words = Counter()
    for r in plan:
        words[r.src] += r.words
    assert all(abs(words[s.number] - s.target) <= 0.5 for s in sources)
    # Every long stretch of the mix has nearly the shares of the whole.
    share = {s.number: s.target / sum(x.target for x in sources) for s in sources}
    part = [r.src for r in plan[: len(plan) // 2]]
    for s in sources:
        assert part.count(s.number) / len(part) == pytest.approx(share[s.number], abs=0.03)
    used = Counter((r.src, r.block, r.epoch) for r in plan)
    assert max(used.values()) == 1


def test_taken_as_brute_force(spark):
    """Blocks laid over each source's shuffled words, with multiplicities from the schedule."""
    docs = cases.documents(spark, n=120, awkward=False)
    rows = mixing.sizes(docs)
    sources = mixing.sources_of(rows, mixing.WEIGHTS, 1.5, 2.0)
    goal = {s.number: int(s.target + 0.5) for s in sources}
    number = {s.name: s.number for s in sources}
    hashed = rows.selectExpr("*", "xxhash64(0, doc_id, h) at").collect()
    want = {}
    for s in sources:
        at = 0
        for r in sorted((r for r in hashed if number[r.source] == s.number), key=lambda r: r["at"]):
            span = np.arange(at, at + r["size"])
            want[r.doc_id] = int(sum((span + e * s.size < goal[s.number]).sum() for e in range(3)))
            at += r["size"]
    assert {r.doc_id: r.taken for r in mixing.mix(docs, block=32).collect()} == want


def test_whole_documents(spark):
    docs = cases.clashing(cases.documents(spark, n=200))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    counts = Counter(r.doc_id for r in out.collect() if r.doc_id is not None and r.doc_id < 1000)
    assert max(counts.values()) == 2
    assert set(cases.rows_of(out)) <= set(cases.rows_of(docs))


def test_no_rows_and_no_words(spark):
    docs = cases.documents(spark)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mixed(docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", 0), (2, "", None, None, 0)], cases.SCHEMA)
    assert [(r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0.0)] * 2
    assert mixing.mixed(blank).count() == 0
