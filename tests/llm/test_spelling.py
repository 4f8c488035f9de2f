"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from concord.llm import spelling as S


def near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute_words(rows):
    n = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(n):
    forms, out = {}, []
    close = {w: [v for v in n if near(w, v)] for w in n}
    for w, vs in close.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n[w], len(close[w]), n[forms[w]] if forms[w] else None))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def vocabulary(seed, size, letters="abé", low=5, high=9):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(low, high))) for _ in range(size)}
    return {w: rng.choice([3, 4, 6, 8, 12, 30, 100]) for w in words}


@pytest.mark.parametrize("seed", range(4))
def test_search_finds_each_near_word_once(seed):
    rng = random.Random(seed)
    words = sorted(vocabulary(seed, rng.choice([1, 3, 60, 200])))
    index = S.Vocabulary(words)
    for left in (True, False):
        q, w = index.near(np.arange(len(words)), left)
        want = [(a, b) for a, u in enumerate(words) for b, v in enumerate(words) if near(u, v)
                and (v.startswith(u[:len(u) // 2]) and near(u[len(u) // 2:], v[len(u) // 2:]) if left
                     else v.endswith(u[len(u) // 2:]) and near(u[:len(u) // 2], v[:len(v) - len(u) + len(u) // 2]))]
        assert sorted(zip(q.tolist(), w.tolist())) == want


def test_wide_alphabet():
    rng = random.Random(1)
    letters = [chr(0x4E00 + i) for i in range(400)]
    words = sorted({"".join(rng.choice(letters) for _ in range(5)) for _ in range(50)})
    words = sorted({*words, *[w[:2] + rng.choice(letters) + w[3:] for w in words]})
    q, w = S.Vocabulary(words).near(np.arange(len(words)), True)
    assert sorted(zip(q.tolist(), w.tolist())) == [(a, b) for a, u in enumerate(words) for b, v in enumerate(words)
                                                   if near(u, v) and u[:2] == v[:2]]


@pytest.mark.parametrize("block,group", [(S.BLOCK, S.GROUP), (200, 7)])
def test_equals_brute_force(spark, block, group):
    n = vocabulary(11, 500) | vocabulary(12, 60, "abcdefghijklmnop", 5, 6) | {"chaining": 3, "chainink": 6, "chainick": 12, "chaimick": 24}
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    assert got(S.spelling_variants(df, block=block, group=group)) == brute(n)


def test_documents(docs_table):
    rng = random.Random(4)
    base = ["colour", "Größe", "naïve", "ÀLPHA", "theatre", "abcd", "tiny", "xxxxx"]
    rows = [(i, " ".join(rng.choice(base) + rng.choice(["", "", "s", "1"]) for _ in range(40))) for i in range(300)]
    rows += [(None, "colours colours"), (None, None), (5, ""), (6, "z" * 100_000 + " " + "z" * 100_000), (6, "z" * 100_000), rows[0], rows[0]]
    df = docs_table(rows)
    words = S.counted(df).filter("n >= 3")
    assert {r.word: r.n for r in words.collect()} == brute_words(rows)
    assert got(S.spelling_variants(words)) == brute(brute_words(rows))


def test_empty(docs_table):
    assert got(S.spelling_variants(S.counted(docs_table([])).filter("n >= 3"))) == []
    assert got(S.spelling_variants(S.counted(docs_table([(1, None), (2, "a b c")])).filter("n >= 3"))) == []
