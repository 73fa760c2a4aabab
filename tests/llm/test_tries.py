import hashlib
import random
import zlib
from collections import defaultdict

import cases
import pytest

from headway.llm import queries, tries

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            coded = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, coded, (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def nodes_by_hand(rebuilt):
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)

    out = []
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[k] for k in children[node]]
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (sum(b[0] for b in below) or 1, own + sum(b[1] for b in below))
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            *sums[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations(seed=1, n=150):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), *range(200, 200 + n), 1000, 1001]:
        said = rng.choice(["x", "xy", "z", "common start", "ñandú 😀"])
        rows += [(c, k, rng.choice(["user", "assistant"]), said if rng.random() < 0.6 else f"t{rng.randint(0, 3)}")
                 for k in range(rng.randint(1, 7))]
    rows += [(c, k, "user", f"long {k if c % 3 else k // 2}") for c in range(2000, 2012) for k in range(60)]
    rows += [(c, k, "user", "same") for c in range(3000, 3100) for k in range(3)]
    rows += [(5000, None, None, None), (5000, 1, None, "a"), (5000, 1, "user", None), (5000, 1, None, "a"),
             (None, 0, "user", "nobody"), (5001, 0, "", ""), (5002, 0, None, None)]
    return rows


@pytest.mark.parametrize("room", [0, 5, 40, 1 << 15])
def test_nodes_against_brute_force(spark, room, monkeypatch):
    monkeypatch.setattr(tries, "CHUNK", 7)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    found = tries.trie(tries.sequences(tries.regrown(tries.turns_of(df))), room=room)
    assert cases.rows_of(found) == nodes_by_hand(rebuilt_by_hand(rows))


def test_query_with_clashing_columns_and_any_partitioning(spark, tmp_path):
    rows = conversations(seed=2, n=60)
    cases.clashing(spark.createDataFrame(rows, SCHEMA).repartition(5)).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op12_conversation_trie(spark, str(tmp_path))
    assert cases.rows_of(found) == nodes_by_hand(rebuilt_by_hand(rows))


def test_no_conversations(spark):
    df = spark.createDataFrame([(None, 0, "user", "nobody")], SCHEMA)
    assert tries.trie(tries.sequences(tries.turns_of(df))).count() == 0


def test_turnless_conversation_ends_at_the_root(spark):
    df = spark.createDataFrame([(4, []), (9, [])], "conv_id long, turns array<struct<id: string, n: int>>")
    rows = tries.trie(tries.sequences(df)).collect()
    assert [tuple(r) for r in rows] == [(4, 0, None, 2, 0, 1, 0, hashlib.sha256(b"4,9").hexdigest())]
