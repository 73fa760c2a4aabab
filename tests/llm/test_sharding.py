from collections import Counter

import cases
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm import sharding


@settings(max_examples=60, deadline=None)
@given(rows=st.integers(1, 5000), seed=st.integers(0, 2**31))
def test_permutation_and_inverse(rows, seed):
    numbers = np.arange(rows)
    out = sharding.permute(numbers, rows, seed)
    assert sorted(out) == list(range(rows))
    assert (sharding.permute(out, rows, seed, forward=False) == numbers).all()


def test_large_ranges_stay_inside():
    rows = 10**15 + 7
    numbers = np.array([0, 1, rows // 2, rows - 1])
    out = sharding.permute(numbers, rows, 3)
    assert ((out >= 0) & (out < rows)).all()
    assert (sharding.permute(out, rows, 3, forward=False) == numbers).all()


def test_shard_and_slot_are_computable(spark):
    docs = cases.documents(spark, awkward=False)
    order = [r.doc_id for r in docs.orderBy("doc_id").collect()]
    found = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(docs, 7, seed=5).collect()}
    for number, doc_id in enumerate(order):
        assert sharding.locate(number, len(order), 7, 5) == found[doc_id]
        assert sharding.row_at(*found[doc_id], len(order), 7, 5) == number


def test_counts_slots_and_whole_rows(spark):
    docs = cases.clashing(cases.documents(spark))
    out = sharding.shard_rows(docs, 6)
    assert out.columns == [*docs.columns, "shard", "slot"]
    rows = out.collect()
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert cases.rows_of(out.drop("shard", "slot")) == cases.rows_of(docs)


def test_same_result_for_any_partitioning(spark):
    docs = cases.documents(spark)
    one = cases.rows_of(sharding.shard_rows(docs.coalesce(1), 5))
    assert one == cases.rows_of(sharding.shard_rows(docs.repartition(7), 5))


def test_more_shards_than_rows_and_no_rows(spark):
    docs = cases.documents(spark, n=10, awkward=False).limit(3)
    assert sorted((r.shard, r.slot) for r in sharding.shard_rows(docs, 10).collect()) == [(0, 0), (1, 0), (2, 0)]
    assert sharding.shard_rows(docs.limit(0), 10).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_rows(docs, 0)
