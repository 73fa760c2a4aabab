import math
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from headway.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def symbols(text):
    return quality._symbols(text or "").tolist()


class Brute:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.c3 = Counter()
        for t in texts:
            s = symbols(t)
            self.c3.update(zip(s, s[1:], s[2:]))
        self.c2 = Counter((b, c) for _, b, c in self.c3)
        self.c1 = Counter(c for _, c in self.c2)
        self.d = [self.discounts(x) for x in (self.c3, self.c2, self.c1)]
        self.h3, self.h2 = self.contexts(self.c3, self.d[0]), self.contexts(self.c2, self.d[1])
        self.total = sum(self.c1.values())
        self.left = sum(self.cut(n, self.d[2]) for n in self.c1.values()) / self.total / (len(self.c1) + 1)

    @staticmethod
    def discounts(c):
        n = [sum(v == k for v in c.values()) for k in range(1, 5)]
        if not n[0] or not n[1]:
            return 0.5, 0.75, 1.0
        y = n[0] / (n[0] + 2 * n[1])
        raw = (1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.0)
        return tuple(min(max(x, 0.05), k + 0.95) for k, x in enumerate(raw))

    @staticmethod
    def cut(n, d):
        return d[min(n, 3) - 1]

    def contexts(self, c, d):
        out = defaultdict(lambda: [0, 0.0])
        for key, n in c.items():
            out[key[:-1]][0] += n
            out[key[:-1]][1] += self.cut(n, d)
        return out

    def p(self, a, b, c):
        p1 = self.left + ((self.c1[c] - self.cut(self.c1[c], self.d[2])) / self.total if c in self.c1 else 0)
        p2, p3 = p1, None
        if (b,) in self.h2:
            total, left = self.h2[b,]
            p2 = left / total * p1
            if (b, c) in self.c2:
                p2 += (self.c2[b, c] - self.cut(self.c2[b, c], self.d[1])) / total
        if (a, b) not in self.h3:
            return p2
        total, left = self.h3[a, b]
        p3 = left / total * p2
        if (a, b, c) in self.c3:
            p3 += (self.c3[a, b, c] - self.cut(self.c3[a, b, c], self.d[0])) / total
        return p3

    def score(self, text):
        s = symbols(text)
        if len(s) <= 3:
            return None
        return -sum(math.log(self.p(*g)) for g in zip(s, s[1:], s[2:])) / (len(s) - 2)


def labelled(spark, docs):
    ids = sorted(r.doc_id for r in docs.collect() if r.doc_id is not None)
    return spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in ids[:40]] + [(None, 1, 0), (41, None, None)], LABELS)


def test_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(quality, "PIECE", 2000)  # several blocks, several pieces of the long text
    docs = cases.documents(spark)
    labels = labelled(spark, docs)
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0 and r.doc_id is not None}
    model = Brute([r.text for r in docs.collect() if r.doc_id in trusted and r.text is not None])
    found = quality.perplexities(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long"))
    rows = found.join(docs.selectExpr("doc_id", "xxhash64(text) h", "text").distinct(), ["doc_id", "h"], "left")
    assert found.count() == docs.count()
    checked = 0
    for r in rows.filter("doc_id IS NOT NULL").collect():
        want = model.score(r.text)
        assert (r.score is None) == (want is None)
        if want is not None:
            assert r.score == pytest.approx(want, abs=2e-4)
            checked += 1
    assert checked > 60


def test_probabilities_sum_to_one(spark):
    model = Brute(["abab abc", "abc bca"])
    known = [*model.c1, 0x10FFFF]  # and one never seen
    for context in [(97, 98), (98, 99), (1, 2)]:
        assert sum(model.p(*context, c) for c in known) == pytest.approx(1.0)


def test_thresholds_by_language(spark):
    docs = cases.documents(spark, n=300, awkward=False)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], LABELS)
    rows = quality.classify(docs, labels, low=0.1, high=0.9, least=20).collect()
    for lang in ("en", "de"):
        trusted = sorted(r.perplexity for r in rows if r.lang == lang and r.doc_id < 200)
        low, high = (trusted[max(0, math.ceil(len(trusted) * q) - 1)] for q in (0.1, 0.9))
        mine = [r for r in rows if r.lang == lang]
        assert {(round(r.low, 9), round(r.high, 9)) for r in mine} == {(round(low, 9), round(high, 9))}
        assert all(r.kept == (low <= r.perplexity <= high) for r in mine)


def test_junk_goes_and_prose_stays(spark):
    docs = cases.documents(spark, n=300, awkward=False)
    junk = spark.createDataFrame([(5000 + i, "##%% ZQ!! XJ&& " * 20, "en", "s", 0) for i in range(20)], cases.SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], LABELS)
    out = quality.good_documents(docs.union(junk), labels)
    ids = [r.doc_id for r in out.collect()]
    assert max(ids) < 5000 and len(ids) > 0.95 * docs.count()


def test_awkward_rows_and_empty_tables(spark):
    docs = cases.clashing(cases.documents(spark))
    labels = labelled(spark, docs)
    out = quality.good_documents(docs, labels)
    assert out.columns == docs.columns
    assert out.filter("text IS NULL OR trim(text) = ''").count() == 0
    assert quality.classify(docs, labels).count() == docs.count()
    assert quality.classify(docs.limit(0), labels).count() == 0
    every = quality.classify(docs, labels.limit(0))
    assert all(r.kept == (r.length > 1) for r in every.collect())


def test_exact_quantiles(spark):
    rng = np.random.default_rng(0)
    values = np.round(rng.normal(size=500), 1)
    df = spark.createDataFrame([(float(v), 1) for v in values], "score double, k int")
    row = quality._quantiles(df, ["k"], 0.25, 0.9).first()
    ordered = sorted(values)
    assert (row.low, row.high) == (ordered[124], ordered[449])


def test_repeated_words_go(spark):
    docs = cases.documents(spark, n=300, awkward=False)
    words = [w + end for w in cases.WORDS for end in ("", "s")]
    junk = [(5000 + i, f"{w} " * (40 + 10 * i), "en", "s", 0) for i, w in enumerate(words)]
    junk += [(6000 + i, f"River stones. {w} " + f"{w} " * 80, "de", "s", 0) for i, w in enumerate(words)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], LABELS)
    out = quality.good_documents(docs.union(spark.createDataFrame(junk, cases.SCHEMA)), labels)
    ids = [r.doc_id for r in out.collect()]
    assert max(ids) < 5000 and len(ids) > 0.95 * docs.count()


def test_rare_languages_have_their_own_limits(spark):
    other = str.maketrans("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщ")
    common = [(r.doc_id, r.text, "en", "s", 0) for r in cases.documents(spark, n=300, awkward=False).collect()]
    rare = [(1000 + k, t.lower().translate(other), "rare", "s", 0) for k, (_, t, *_) in enumerate(common[:60])]
    none = [(2000 + k, t, "none", "s", 0) for k, (_, t, *_) in enumerate(rare)]
    junk = [(3000, "ЖЖ##%% ЩЩ!! " * 20, "rare", "s", 0)]
    docs = spark.createDataFrame(common + rare + none + junk, cases.SCHEMA)
    few = {}
    for n in (1, 10, 49, 50):
        labels = spark.createDataFrame([(i, 1, 0) for i in (*range(200), *range(1000, 1000 + n))], LABELS)
        rows = quality.classify(docs, labels).collect()
        mine = [r for r in rows if r.lang == "rare" and r.doc_id < 3000]
        own = [r.perplexity for r in mine if r.doc_id < 1000 + n]
        assert all(r.low <= min(own) and r.high >= max(own) and r.high < 3 * max(own) for r in mine)
        few[n] = sum(r.kept for r in mine)
        assert not next(r for r in rows if r.doc_id == 3000).kept
        assert {(r.low, r.high, r.kept) for r in rows if r.lang == "none"} == {(1.0, math.inf, True)}
    assert few[10] > 50 and few[49] > 55 and few[49] <= few[50]
