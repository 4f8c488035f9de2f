import hashlib
import random

import numpy as np
import pytest

from concord.llm.queries import QUERIES
from concord.llm.suffix import equal_prefix_classes, remove_repeats, suffix_order


def brute(rows, length=100):
    """(doc_id, bytes, removed, spans, digest) per row, by a dictionary of all windows in order."""
    docs = sorted({(d is None, d or 0, t or "") for d, t in rows})
    seen, done = set(), {}
    for null, d, t in docs:
        data = t.encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        for i in range(len(data) - length + 1):
            w = data[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            else:
                seen.add(w)
        spans = int((np.diff(gone[:-1].astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone) if not g)
        done[(None if null else d), t] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted((str(d), *done[d, t or ""]) for d, t in rows)


def result(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def random_text(rng, n, letters="abcdé \n"):
    return "".join(rng.choice(letters) for _ in range(n))


@pytest.mark.parametrize("seed", range(4))
def test_classes_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(15):
        length = rng.choice([1, 2, 3, 7])
        pieces = [np.frombuffer(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 30))), dtype=np.uint8)
                  for _ in range(rng.randrange(1, 9))]
        group, piece, offset = equal_prefix_classes(pieces, length)
        got = {}
        for g, p, o in zip(group, piece, offset):
            got.setdefault(g, set()).add((p, o))
        want = {}
        for p, b in enumerate(pieces):
            for o in range(len(b) - length + 1):
                want.setdefault(b[o:o + length].tobytes(), set()).add((p, o))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_suffix_order():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 300):
        text = np.append(rng.integers(1, 3, n), 0)
        assert suffix_order(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())


def test_documents_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(QUERIES["op5_suffix_dedup"](spark, sf)) == brute(rows)


def planted(rng):
    base = [random_text(rng, rng.randrange(100, 500)) for _ in range(6)]
    rows = []
    for i in range(50):
        t = random_text(rng, rng.randrange(0, 300))
        for _ in range(rng.randrange(0, 4)):
            b = rng.choice(base)
            a = rng.randrange(len(b))
            t += b[a:a + rng.randrange(50, 400)] + random_text(rng, rng.randrange(0, 40))
        rows.append((i, t))
    rows += [(60, None), (61, ""), (62, "x" * 99), (63, "x" * 100), (64, "x" * 101), (65, "ab" * 400), (66, "é" * 300),
             (67, "abc" * 500 + "d"), (68, rows[3][1]), (69, rows[3][1] + "tail"), (70, random_text(rng, 300_000, "abcdefgh"))]
    rows.append((71, rows[-1][1][100_000:]))
    return rows


def test_planted_repeats(spark, docs_table):
    rows = planted(random.Random(5))
    docs = docs_table(rows)
    want = brute(rows)
    assert result(remove_repeats(docs)) == want
    # small blocks, and every anchor with more than two contexts split into windows
    assert result(remove_repeats(docs, block_bytes=500, group=2)) == want
    assert result(remove_repeats(docs, length=57)) == brute(rows, 57)


def test_repeated_and_missing_ids(spark, docs_table):
    rng = random.Random(6)
    a, b = random_text(rng, 250), random_text(rng, 250)
    rows = [(1, a), (1, a), (2, b), (None, a), (None, b + a), (3, b), (3, None)]
    want = dict.fromkeys([("1", 250), ("2", 250)], 0)
    got = remove_repeats(docs_table(rows), keep_text=True).collect()
    assert len(got) == len(rows)
    for r in got:
        n = len(r.kept)
        if r.doc_id in (1, 2):
            assert r.n_removed == 0 and n == 250
        elif r.doc_id == 3:
            assert n == 0
        else:
            assert n <= 1 and r.n_bytes - r.n_removed <= 1  # all of it is known by then
    assert want


def test_kept_text_is_whole_characters(spark, docs_table):
    rng = random.Random(9)
    shared = random_text(rng, 150, "éßñ")
    rows = [(1, "a" + shared + "b"), (2, "x" + shared + "y"), (3, "é" + shared[1:] + "z")]
    for r in remove_repeats(docs_table(rows), keep_text=True).collect():
        assert "�" not in r.kept and len(r.kept.encode()) >= r.n_bytes - r.n_removed
    assert [r.kept for r in remove_repeats(docs_table(rows), keep_text=True).orderBy("doc_id").collect()][1] == "xy"


def test_empty(spark, docs_table):
    assert remove_repeats(docs_table([])).count() == 0
