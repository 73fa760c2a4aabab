import random
import re

import cases
import numpy as np

from headway.llm import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    words, hit, found = split(text), set(), set()
    for item, other in items:
        other = split(other)
        size = min(window, len(other))
        for at in range(len(other) - size + 1) if size else ():
            for place in range(len(words) - size + 1):
                if words[place : place + size] == other[at : at + size]:
                    hit.update(range(place, place + size))
                    found.add(item)
    return len(words), len(hit), sorted(map(str, found))


def bench(spark, rng):
    items = [(i, cases.prose(rng, rng.randint(10, 40))) for i in range(12)]
    items += [(20, "Amber willow."), (21, "a a a a a a a a a a a a"), (22, None), (23, "?!"), (24, "copper"), (25, items[0][1])]
    return items, spark.createDataFrame(items, "item_id long, text string")


def leaked(rng, items):
    rows = []
    for i in range(40):
        words = cases.prose(rng, 50).split()
        if i % 2 == 0:
            other = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, max(0, len(other) - 12))
            cut = other[at : at + rng.randint(6, 20)]
            place = rng.randint(0, 50)
            words[place:place] = [w.upper() + "!" for w in cut]
        rows.append((i, " ".join(words), "en", "s", 0))
    rows.append((90, "a " * 200 + "b", "en", "s", 0))
    return rows


def test_as_brute_force_in_one_block_and_several(spark):
    rng = random.Random(11)
    items, table = bench(spark, rng)
    docs = spark.createDataFrame(leaked(rng, items), cases.SCHEMA).union(cases.documents(spark))
    texts = {(r.doc_id, r.h): r.text for r in docs.selectExpr("doc_id", "xxhash64(text) h", "text").collect()}
    one = contamination.contamination(docs, table).collect()
    assert len(one) == docs.count() and sum(r.contaminated for r in one) > 10
    for r in one:
        want = brute(texts[r.doc_id, r.h], items)
        assert (r.n_words, r.n_hit, list(r.items)) == want
        assert r.contaminated == (want[1] > 0)
    many = contamination.contamination(docs, table, block_words=30)
    names = ["doc_id", "h", "n_words", "n_hit", "items", "contaminated"]
    assert cases.rows_of(many.select(names)) == sorted((tuple(r[n] for n in names) for r in one), key=repr)


def test_filter_keeps_exactly_the_clean_rows(spark):
    rng = random.Random(12)
    items, table = bench(spark, rng)
    docs = cases.clashing(spark.createDataFrame(leaked(rng, items), cases.SCHEMA).union(cases.documents(spark)))
    clean = contamination.decontaminated(docs, table)
    assert clean.columns == docs.columns
    want = [r for r in docs.collect() if not brute(r.text, items)[1]]
    assert cases.rows_of(clean) == sorted(map(tuple, want), key=repr)
    assert cases.rows_of(contamination.decontaminated(docs, table, block_words=30)) == cases.rows_of(clean)


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    for _ in range(200):
        shared = rng.integers(0, 6, 6)  # six grams: a span of ten words
        left, right = (np.concatenate([rng.integers(0, 6, 5), shared, rng.integers(0, 6, 5)]).astype(np.uint64) for _ in range(2))
        a, b = ({int(p) - 5 for p in contamination.winnow(x, 6)} for x in (left, right))
        assert {p for p in a if 0 <= p < 6} & {p for p in b if 0 <= p < 6}


def test_empty_tables(spark):
    docs = cases.documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.contamination(docs, none).filter("contaminated").count() == 0
    assert contamination.decontaminated(docs, none).count() == docs.count()
    items = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert contamination.contamination(docs.limit(0), items).count() == 0
