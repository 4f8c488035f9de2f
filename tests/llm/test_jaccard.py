import random
import re
from collections import defaultdict

import numpy as np

from concord.llm.jaccard import (bitmap, differing_bits, jaccard_components, leading_rows, need, shared_rows, unit_pairs,
                                 unpack)
from concord.llm.queries import QUERIES
from concord.llm.textarrays import shingle_set

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows, percent=80):
    """(doc_id, size, least id of the class) per row: every pair that shares a shingle is compared."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        near = {j for x in s for j in holders[x]}
        for j in near:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (r not in least or d < least[r]):
            least[r] = d
    return sorted((str(d), len(sets[i]), str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def result(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def words(rng, n):
    return ["".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 6))) for _ in range(n)]


def test_documents_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(QUERIES["op6_ngram_jaccard"](spark, sf)) == brute(rows)


def test_planted_links_and_edges(spark, docs_table):
    rng = random.Random(11)
    passage = words(rng, 30)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c d e"), (8, "a b c d e"),
            (8, "a b c d e"), (8, "quite another text with the same id"), (None, "a B c d e"), (None, "alone with no id here")]
    for g in range(14):
        base = words(rng, rng.randrange(6, 160))
        for k in range(12):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = "x" + str(rng.randrange(9))
            at = rng.randrange(len(w))
            rows.append((1000 + 100 * g + k, " ".join(w if k % 3 else w[:at] + passage + w[at:])))
    chain = words(rng, 60)
    for k in range(25):  # each is alike to the next, the ends are not
        rows.append((5000 + (k * 7) % 25, " ".join(chain)))
        chain = chain[2:] + words(rng, 2)
    rows.append((6000, " ".join(words(rng, 30_000))))
    want = brute(rows)
    docs = docs_table(rows)
    assert result(jaccard_components(docs)) == want
    assert result(jaccard_components(docs, block_nodes=2)) == want  # tiles spread over pairs of blocks
    assert result(jaccard_components(docs, max_common=0)) == want  # any order of shingles


def test_empty_table(spark, docs_table):
    assert jaccard_components(docs_table([])).count() == 0
    assert result(jaccard_components(docs_table([(3, None), (4, "")], "f"))) == [("3", 0, "3"), ("4", 0, "4")]


def test_bitmaps_never_rule_out_an_alike_pair():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 3000))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 63, n // 9 + 1, dtype=np.uint64)]))
        x, y = bitmap(a), bitmap(b)
        bits = 8 * min(len(x), len(y))
        apart = int(np.bitwise_count(unpack([x], bits) ^ unpack([y], bits)).sum())
        assert len(np.intersect1d(a, b)) <= (len(a) + len(b) - apart) // 2
        assert 180 * need(len(a), len(b), 80) >= 80 * (len(a) + len(b)) > 180 * (need(len(a), len(b), 80) - 1)


def test_shingle_set_has_one_hash_a_shingle():
    rng = random.Random(8)
    for n in (0, 1, 4, 5, 6, 50, 3000):
        text = "\t \n".join(words(rng, n)) + "  "
        text = text.upper() if n % 2 else text
        assert len(shingle_set(np.frombuffer(text.encode(), dtype=np.uint8))) == len(shingles(text))
    long = "z" * 700_000 + " " + " ".join(words(rng, 200_000))
    got = shingle_set(np.frombuffer(long.encode(), dtype=np.uint8))
    assert len(got) == len(shingles(long))


def test_pairs_within_units():
    rng = np.random.default_rng(5)
    unit = np.sort(rng.integers(0, 30, 200))
    got = {(int(i), int(j)) for a, b in unit_pairs(unit) for i, j in zip(a, b)}
    assert got == {(i, j) for i in range(200) for j in range(i + 1, 200) if unit[i] == unit[j]}


def test_differing_bits_fold_the_longer_bitmap():
    rng = np.random.default_rng(6)
    maps = [bitmap(rng.integers(0, 1 << 63, int(k), dtype=np.uint64)) for k in rng.integers(1, 900, 40)]
    length = np.array([len(m) // 8 for m in maps])
    left, right = np.divmod(np.arange(1600), 40)
    got = differing_bits(np.frombuffer(b"".join(maps), dtype=np.uint64), np.cumsum(length) - length, length, left, right)
    for i, j, k in zip(left, right, got):
        bits = 8 * min(len(maps[i]), len(maps[j]))
        assert k == np.bitwise_count(unpack([maps[i]], bits) ^ unpack([maps[j]], bits)).sum()


def test_leading_shingles_are_made_and_shuffled_once(spark):
    rng = random.Random(3)
    base = [words(rng, 40) for _ in range(6)]
    rows = [(i, " ".join(base[i % 6] if i < 12 else base[i % 6][:30] + words(rng, 4 + i % 3))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lead = leading_rows(docs, np.zeros(0, np.uint64), 80, 5)
    holders = defaultdict(set)
    for r in lead.collect():
        holders[r.shingle].add((r.node, r.n))
    shared = shared_rows(lead)
    want = sorted((s, node, n) for s, of in holders.items() if len(of) > 1 for node, n in of)
    assert want and sorted(tuple(r) for r in shared.collect()) == want
    plan = shared._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("MapInArrow") == 1 and plan.count("Exchange hashpartitioning") == 1
