import hashlib
import random
import re

import cases

from headway.llm import queries, secret_scan

ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""
)


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def secret_rows(rng, n=60):
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    upper = lambda k: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(k))
    rows = []
    for i in range(n):
        extra = rng.choice([
            f'toKen = "{hexa(40)}"', f"AKIA{upper(16)}", f"api_key:{hexa(12)}", f"passwd='{upper(8)}-x'", "password = abc",
            hexa(32), "AKIAAKIA12", f"secret==={hexa(30)}", "ſecret: aaaaaaaa", f"😀 API-KEY=1 apikey={upper(9)}", "",
        ])
        rows.append((i, f"{cases.prose(rng, 20)} {extra} {cases.prose(rng, 10)}", "en", "s", 0))
    return rows


def test_base_spans_as_brute_force(spark):
    rows = secret_rows(random.Random(4)) + [(900, None, None, None, 0), (901, "", None, None, 0)]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    docs.write.mode("overwrite").parquet(path := f"{_folder()}/documents.parquet")
    out = {r.doc_id: r for r in queries.op5_secret_scan(spark, path.removesuffix("/documents.parquet")).collect()}
    assert len(out) == len(rows)
    for doc_id, text, *_ in rows:
        want = brute(text or "")
        assert out[doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (out[doc_id].n_assign, out[doc_id].n_access, out[doc_id].n_hex) == tuple(
            want.count(k) for k in secret_scan.KINDS
        )
        assert set(filter(None, want.split(","))) <= set(out[doc_id].spans.split(","))


def _folder():
    import tempfile

    return tempfile.mkdtemp(prefix="headway-test-")


def test_automata_tell_held_out_credentials_from_words():
    rng = random.Random(5)
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    hexa = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    word = lambda: "".join(rng.choice(cases.WORDS) for _ in range(3))
    models = [secret_scan.infer([f() for _ in range(300)]) for f in (key, hexa)]
    words = secret_scan.infer([word() for _ in range(300)])
    judge = lambda w: secret_scan.likely(w, models, words, 1.0)
    assert sum(judge(key()) for _ in range(200)) >= 190
    assert sum(judge(hexa()) for _ in range(200)) >= 190
    assert sum(judge(word()) for _ in range(200)) <= 4


def test_merging_makes_small_automata():
    rng = random.Random(6)
    values = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(400)]
    assert len(secret_scan.infer(values).moves) < 200
    assert secret_scan.infer([]).score("a") < 0


def test_model_adds_bare_credentials(spark):
    rng = random.Random(7)
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    rows = [(i, f'{cases.prose(rng, 30)} token = "{hexa(40)}" {"".join(rng.choice(cases.WORDS) for _ in range(4))}', "en", "s", 0) for i in range(80)]
    rows.append((100, f"see {hexa(20)} there", "en", "s", 0))
    out = {r.doc_id: r for r in secret_scan.secrets(spark.createDataFrame(rows, cases.SCHEMA)).collect()}
    assert not out[100].base and [(s.start, s.stop, s.kind) for s in out[100].spans] == [(4, 24, "model")]
    assert sum(len(out[i].spans) - len(out[i].base) for i in range(80)) == 0


def test_formats_of_credentials_and_ordinary_tokens():
    rng = random.Random(8)
    pick = lambda letters, k: "".join(rng.choice(letters) for _ in range(k))
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    syllables = "an de ti on er ing th re sh ou ble ment ly co ra".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(3, 6)))
    numbers = [
        lambda: pick(digits, 16), lambda: f"20{pick(digits, 2)}-{pick('01', 2)}-{pick('012', 2)}",
        lambda: f"555-{pick(digits, 4)}", lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        lambda: f"{word()}.{pick(digits, 2)}", lambda: f"www.{word()}.com/{word()}",
    ]
    other = lambda: rng.choice(numbers)()
    kinds = {
        "hex": lambda: pick("0123456789abcdef", 40), "access": lambda: "AKIA" + pick(lower.upper() + "234567", 16),
        "short": lambda: pick(lower + lower.upper() + digits, 12), "jwt": lambda: "eyJ" + ".".join(pick(lower + lower.upper() + digits, 30) for _ in "123"),
    }
    models = [secret_scan.infer([make() for _ in range(300)]) for make in kinds.values()]
    assert all(len(m.moves) > 1 for m in models)
    words = secret_scan.Mixture([
        (0.9, secret_scan.infer([word() for _ in range(1500)], coding=secret_scan.LETTERS)),
        (0.1, secret_scan.infer([other() for _ in range(1500)], coding=secret_scan.LETTERS)),
    ])
    for make in kinds.values():
        assert sum(secret_scan.likely(make(), models, words) for _ in range(300)) >= 270
    for make in (word, lambda: word().capitalize() + word(), *numbers):
        assert sum(secret_scan.likely(make(), models, words) for _ in range(300)) <= 3


def test_candidates_start_at_six_characters_and_keep_marks():
    found = secret_scan.candidates("is a1b2c3, or eyJh.bGci.x9. .abcde and abcde", [])
    assert [v for _, _, v in found] == ["a1b2c3", "eyJh.bGci.x9"]


def test_sample_holds_the_smallest_hashes():
    import zlib

    kept = secret_scan._Smallest(20)
    values = [f"v{k % 150}" for k in range(600)]
    for v in values:
        kept.add(v)
    want = sorted(set(values), key=lambda v: zlib.crc32(v.encode()))[:20]
    assert {v for _, v in kept.heap} == set(want)


def test_automata_of_the_tables_have_states_and_add_no_numbers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models, _ = secret_scan.fit(docs)
    assert models and all(len(m.moves) > 1 for m in models)
    spans = [s for r in secret_scan.secrets(docs).collect() for s in r.spans if s.kind == secret_scan.MODEL]
    assert not [s.value for s in spans if s.value.isdigit()]


def test_awkward_rows(spark):
    docs = cases.clashing(cases.documents(spark))
    out = secret_scan.secrets(docs)
    assert out.count() == docs.count()
    assert all(not r.spans for r in out.collect())
    assert secret_scan.secrets(docs.limit(0)).count() == 0
