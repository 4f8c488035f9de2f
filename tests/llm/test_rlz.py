"""Removal of repeated passages against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from concord.llm import rlz as R


def brute(rows, length=35):
    docs = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(w[i:i + length]) for _, w in docs for i in range(len(w) - length + 1))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i:i + length])] > 1:
                gone.update(range(i, i + length))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_factors_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(10):
        length = rng.choice([1, 2, 3, 5])
        pieces = [np.array([rng.randrange(3) for _ in range(rng.randrange(1, 25))], dtype=np.uint64)
                  for _ in range(rng.randrange(1, 8))]
        n = Counter(tuple(p[i:i + length]) for p in pieces for i in range(len(p) - length + 1))
        want = sorted((k, i) for k, p in enumerate(pieces) for i in range(len(p) - length + 1)
                      if n[tuple(p[i:i + length])] > 1)
        assert sorted(zip(*(x.tolist() for x in R.factor_windows(pieces, length)))) == want


@pytest.mark.parametrize("group,block_words", [(R.GROUP, R.BLOCK_WORDS), (2, 50)])
def test_equals_brute_force(docs_table, group, block_words):
    rng = random.Random(5)
    passages = [words(rng, n) for n in (35, 36, 50, 80, 34)]
    rows = []
    for i in range(60):
        t = words(rng, rng.randrange(0, 120))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            at, cut = rng.randrange(len(t) + 1), rng.randrange(len(p))
            t[at:at] = rng.choice([p, p, p[cut:], p[:cut]])
        rows.append((i, rng.choice([" ", "\n", "\t\x0b "]).join(t)))
    rows += [(70 + i, " ".join(words(random.Random(9), 200))) for i in range(4)]  # copies
    rows += [(80, "same " * 300), (81, "a b " * 100), (82, "same " * 35), (83, "same " * 34)]
    common = words(rng, 14)  # an anchor that many texts share, with other words around it
    rows += [(100 + i, " ".join(words(rng, 30) + common + words(rng, 30))) for i in range(30)]
    df = docs_table(rows)
    assert got(R.remove_passages(df, group=group, block_words=block_words)) == brute(rows)


def test_edge_cases(docs_table):
    rng = random.Random(2)
    long = " ".join(words(rng, 60_000, 10 ** 6))
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, " ".join(words(rng, 50))), (None, " ".join(words(rng, 40))), (4, "Ünï " * 40),
            (5, long), (6, long[-5000:]), (7, "one word here " * 30), (8, " ".join(words(rng, 45)))]
    rows += [rows[-1], rows[-1], rows[0], (8, "another text"), (9, "short twice"), (9, "short twice")]
    assert got(R.remove_passages(docs_table(rows))) == brute(rows)


def test_texts_and_spans(docs_table):
    p = [f"p{i}" for i in range(40)]
    rows = [(1, " ".join(["a", "b", *p, "c"])), (2, "\n".join([*p, "d"]))]
    out = {r.doc_id: r for r in R.remove_passages(docs_table(rows), keep_text=True).collect()}
    assert out[1].kept == "a b c" and [tuple(s) for s in out[1].spans] == [(2, 40)]
    assert out[2].kept == "d" and [tuple(s) for s in out[2].spans] == [(0, 40)]


def test_empty(docs_table):
    assert got(R.remove_passages(docs_table([]))) == []
