import hashlib
import random

import cases

from headway.llm import exact


def test_filter_inserts_deletes_and_overflows():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    bucket = exact.Bucket()
    for i, k in enumerate(keys):
        bucket.insert(k, 1, (i, 0), 1)
    assert bucket.filter.cells > 64 and all(k in bucket.filter for k in keys)
    for k in keys[:1500]:
        bucket.delete(k, 1, 1)
    assert all(k in bucket.filter for k in keys[1500:])
    assert sum(k in bucket.filter for k in keys[:1500]) < 30
    assert set(bucket.keys) == {(k, 1) for k in keys[1500:]}


def test_false_hits_are_verified():
    bucket = exact.Bucket()
    one, two = b"\0" * 8 + b"ab" * 12, b"\1" * 8 + b"ab" * 12  # same mark, same places
    bucket.insert(one, 1, (5, 0), 1)
    assert two in bucket.filter
    bucket.insert(two, 1, (7, 0), 1)
    assert len(bucket.keys) == 2
    bucket.delete(two, 1, 1)
    assert one in bucket.filter and list(bucket.keys) == [(one, 1)]


def test_as_brute_force(spark):
    docs = cases.clashing(cases.documents(spark))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    out = exact.duplicates(docs, buckets=5).collect()
    assert len(out) == len(rows)
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(hashlib.sha256(text.encode()).digest(), []).append(doc_id)
    for r in out:
        group = groups[bytes(r.digest)]
        best = max((i for i in group if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (best, len(group))
        assert not r.kept or r.doc_id == best
    kept = [bytes(r.digest) for r in out if r.kept]
    assert sorted(kept) == sorted(groups)  # one row of each text


def test_index_over_batches(spark):
    rng = random.Random(2)
    rows = [(i, f"text {rng.randint(0, 40)}", None, None, 0) for i in range(200)]
    frames = [spark.createDataFrame(rows[k : k + 50], cases.SCHEMA) for k in range(0, 200, 50)]
    index = exact.update(None, exact.digests(frames[0]), None, 4)
    for f in frames[1:]:
        index = exact.update(index, exact.digests(f), None, 4)
    index = exact.update(index, None, exact.digests(frames[1]), 4)
    left = {}
    for i, text, *_ in rows[:50] + rows[100:]:
        left[text] = left.get(text, 0) + 1
    got = {bytes(r.digest): r.n for r in index.collect()}
    assert got == {hashlib.sha256(t.encode()).digest(): n for t, n in left.items()}
    more = spark.createDataFrame([(999, rows[0][1], None, None, 0), (998, "new", None, None, 0)], cases.SCHEMA)
    found = {r.doc_id: r for r in exact.duplicates(more, stored=index, buckets=4).collect()}
    assert found[999].keep_id == 999 and found[999].group_size == left[rows[0][1]] + 1
    assert found[998].group_size == 1


def test_deleting_the_keeper(spark):
    frame = lambda rows: spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], cases.SCHEMA)
    index = exact.update(None, exact.digests(frame([(1, "a"), (2, "a"), (3, "a"), (3, "a"), (9, "b")])), None, 4)
    index = exact.update(index, exact.digests(frame([(8, "a"), (None, "b")])), None, 4)
    index = exact.update(index, None, exact.digests(frame([(8, "a"), (3, "a"), (9, "b"), (77, "a"), (5, "c")])), 4)
    left = {(r.doc_id, r.n) for r in index.collect()}
    assert left == {(3, 3), (None, 1)}
    found = exact.duplicates(frame([(1, "a"), (2, "a"), (3, "a"), (None, "b")]), stored=index, buckets=4).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in found} == {
        (1, 3, False), (2, 3, False), (3, 3, True), (None, None, True)
    }
    # A row whose number is that of the stored keeper is not the keeper.
    found = exact.duplicates(frame([(2, "a")]), stored=index, buckets=4).collect()
    assert [(r.keep_id, r.kept) for r in found] == [(3, False)]
    index = exact.update(index, exact.digests(frame([(2, "a")])), exact.digests(frame([(3, "a")])), 4)
    assert {(r.doc_id, r.n) for r in index.collect()} == {(2, 3), (None, 1)}


def test_no_rows(spark):
    assert exact.duplicates(cases.documents(spark).limit(0)).count() == 0
