import base64
import hashlib
import random

import cases
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from headway.llm import bpe, queries

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def wanted(library, text):
    ids = library.encode_ordinary(text or "")
    listed = " ".join(map(str, ids)).encode()
    return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_random_texts_with_small_leaves(library, monkeypatch):
    rng = random.Random(3)
    letters = "aaabbst'  \n\t.,1239é中文字ßÄ're'll_-😀　\x85\x1c"
    for leaf in (1, 3, 7):
        monkeypatch.setattr(bpe, "LEAF_CHARS", leaf)
        monkeypatch.setattr(bpe, "LEAF_BYTES", 1 + leaf // 3)
        encoder = bpe.Encoder(bpe.read_ranks(PATH), PATTERN)
        for _ in range(1500):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 50)))
            ids = bpe.unpacked(encoder.encode(text))
            assert ids == library.encode_ordinary(text)
            assert encoder.decode(ids) == text.encode()


@pytest.mark.parametrize("unit", ["a", "ab", "the", "中", "= ", " ", "\n", "'s", "0", "ab1"])
def test_long_runs(library, unit):
    encoder = bpe.Encoder(bpe.read_ranks(PATH), PATTERN)
    for n in (1, 2, 100, 3001):
        assert bpe.unpacked(encoder.encode(unit * n)) == library.encode_ordinary(unit * n)


def test_both_merge_loops_agree():
    rng = random.Random(4)
    encoder = bpe.Encoder(bpe.read_ranks(PATH), PATTERN)
    for _ in range(300):
        data = bytes(rng.choice(b"abcaab the\xc3\xa9") for _ in range(rng.randint(1, 80)))
        assert encoder._few(data) == encoder._many(data)


def test_joined_tokens_are_those_of_the_whole(library):
    rng = random.Random(5)
    encoder = bpe.Encoder(bpe.read_ranks(PATH), PATTERN)
    for _ in range(500):
        one, two = (bytes(rng.choice(b"aabbcetion") for _ in range(rng.randint(1, 60))) for _ in "12")
        assert encoder.join_tokens(encoder.merged(one), encoder.merged(two)) == encoder.merged(one + two)


def test_contract_columns_of_the_query(spark, library, tmp_path):
    docs = cases.clashing(cases.documents(spark))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_byte_bpe(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = [(r.doc_id, *wanted(library, r.text)) for r in docs.select("doc_id", "text").collect()]
    assert cases.rows_of(found) == sorted(want, key=repr)


@pytest.mark.parametrize("span", [16, 61, 400])
def test_spans_joined_up_the_tree(spark, library, span, monkeypatch):
    monkeypatch.setattr(bpe, "FAN_BITS", 2)
    rng = random.Random(span)
    texts = ["".join(rng.choice("ab中 '.s1\n") for _ in range(rng.randint(0, 900))) for _ in range(25)]
    texts += ["z" * 1500, " " * 700, "", None, "word " * 300, "中文" * 200, "a.b" * 150]
    docs = spark.createDataFrame([(k // 2, t) for k, t in enumerate(texts)], "doc_id long, text string")
    blocks = bpe.encoded(docs, PATH, PATTERN, span=span)
    assert blocks.long.count()
    found = bpe.digests(blocks, PATH, PATTERN)
    assert cases.rows_of(found) == sorted(((k // 2, *wanted(library, t)) for k, t in enumerate(texts)), key=repr)
    parts = bpe.decoded(blocks.all(), PATH, PATTERN).collect()
    by_row = {}
    for r in sorted(parts, key=lambda r: r.place):
        key = (r.row, r.alone)
        by_row[key] = by_row.get(key, b"") + bytes(r.bytes)
    assert sorted(by_row.values()) == sorted((t or "").encode() for t in texts)


def test_no_rows(spark):
    docs = cases.documents(spark).limit(0)
    blocks = bpe.encoded(docs, PATH, PATTERN)
    assert blocks.all().count() == 0
    assert bpe.digests(blocks, PATH, PATTERN).count() == 0


def test_ids_are_the_output(spark, library):
    docs = cases.documents(spark, n=8, awkward=False)
    found = {r.doc_id: r.ids for r in bpe.encoded(docs, PATH, PATTERN).all().collect()}
    assert found == {r.doc_id: library.encode_ordinary(r.text) for r in docs.select("doc_id", F.col("text")).collect()}
