"""The conversation trie against brute force over all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from concord.llm import trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth long, k1 string, saved_tokens long"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + v[h:]
    nodes = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    out = []
    for k, m in nodes.items():
        below = [x for x in nodes if x[:len(k)] == k]
        inner = {x[:-1] for x in nodes if x}
        ends = sorted(c for c in m if len(built[c]) == len(k))
        out.append((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m),
                    sum(len(x) == len(k) + 1 for x in below), sum(x not in inner for x in below),
                    sum((len(nodes[x]) - 1) * len(x[-1][1]) for x in below if x),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def made(rows, spark, **kw):
    turns, convs = T.rebuilt(T.numbered(T.turn_hashes(table(spark, rows))))
    return sorted((tuple(r) for r in T.trie(turns, convs, **kw).collect()), key=str)


def sample(seed, n, words):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(4 * n), n):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(words)))
    return rows


@pytest.mark.parametrize("one_shard,queue_rows,shards", [(50_000, 1 << 17, None), (3, 4, 7)])
def test_equals_brute_force(spark, one_shard, queue_rows, shards):
    rows = sample(1, 60, ["a", "é", "tsch\U0001F600s"])
    rows += [(c, t, "user", "same") for c in range(300, 330) for t in range(12)]  # copies of one conversation
    rows += [(c, t, "user", f"w{t}") for c in range(402, 430) for t in range(c - 400)]  # each one turn longer
    rows += [(500 + i, 0, "system", "you are") for i in range(20)] + [(500 + i, 1, "user", f"q{i}") for i in range(20)]
    assert made(rows, spark, one_shard=one_shard, queue_rows=queue_rows, shards=shards) == brute(rows)


def test_edge_cases(spark):
    rows = [(7, 1, "user", "late"), (7, None, "user", "first"), (7, 0, None, "b"), (8, 0, "user", None), (8, 0, "user", None),
            (8, 0, "a", "tie"), (None, 0, "user", "nobody"), (-5, 3, "user", "minus"), (100, 0, "", ""), (101, 0, "x", "y" * 200_000),
            (102, 5, "x", "y" * 200_000), (199, 0, "u", "one turn")]
    assert made(rows, spark) == brute(rows)


def test_empty(spark):
    assert made([], spark) == []
    assert made([(None, 1, "user", "x")], spark) == []


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    q = T.Queue(16, 4)
    items = [(rng.randrange(50), rng.randrange(3), 0, i, 0, 0, 0, 0) for i in range(500)]
    for x in items:
        q.push(x)
    got = []
    for key in sorted({x[:3] for x in items}):
        while m := q.pop(key):
            got.append(m)
        assert q.pop((-1, 0, 0)) is None
    assert sorted(got) == sorted(items) and [x[:3] for x in got] == sorted(x[:3] for x in items)
    q.close()
