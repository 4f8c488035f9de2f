import random

import numpy as np
from pyspark.sql import functions as F

from concord.llm.queries import QUERIES
from concord.llm.weak import BAD, LABELLERS, NONE, em, fit, measure, measured, posterior, score


def test_em_recovers_planted_accuracies():
    rng = np.random.default_rng(1)
    n, m = 40_000, len(LABELLERS)
    good = rng.random(n) < 0.85
    hit = rng.uniform(0.15, 0.5, m)
    votes = np.where(np.where(good[:, None], rng.random((n, m)) < 0.001, rng.random((n, m)) < hit), BAD, NONE)
    patterns = votes @ (3 ** np.arange(m)[::-1])
    u, c = np.unique(patterns, return_counts=True)
    model = em(u, c.astype(float))
    assert abs(model.prior - 0.85) < 0.03
    assert np.abs(model.vote[:, 0, BAD] - hit).max() < 0.06
    assert ((posterior(model, patterns) > 0.5) == good).mean() > 0.95


def test_agrees_with_held_back_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op4_weak_label_quality"](spark, sf).join(labels, "doc_id").collect()
    good, bad = [r for r in rows if r.quality], [r for r in rows if not r.quality]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad)


def test_edge_cases(spark, docs_table):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    clean = lambda n: ". ".join(" ".join(word() for _ in range(8)).capitalize() for _ in range(n)) + "."
    rows = [(i, clean(rng.randrange(2, 30))) for i in range(300)]
    rows += [(400 + i, clean(20).upper().replace(" ", "!! ")) for i in range(30)]
    rows += [(500 + i, " ".join(w + rng.choice(["###", "%%%", "$$$"]) for w in clean(20).split())) for i in range(30)]
    rows += [(600, None), (601, ""), (602, " \n"), (603, clean(8000)), (None, clean(9)), (604, "same " * 300), (5, clean(9))]
    docs = docs_table(rows)
    m = measured(docs)
    model = fit(m)
    got = {}
    for r in docs.select("doc_id", score(model, measure(F.col("text"))).alias("s")).collect():
        got.setdefault(r.doc_id, []).append(r.s)
    assert sum(s.kept for i in range(300) for s in got[i]) >= 298
    assert not any(got[i][0].kept for i in [*range(400, 430), *range(500, 530), 600, 601, 602, 604])
    assert got[603][0].kept and got[None][0].kept and got[600][0].score == 0
    none = fit(m.limit(0))
    assert docs.filter("doc_id = 7").select(score(none, measure(F.col("text"))).alias("s")).collect()[0].s.kept
    assert measured(docs.limit(0)).count() == 0


def test_clean_texts_of_any_script_and_sentence_length(spark, docs_table):
    rng = random.Random(6)

    def clean(alphabet, stop, sentences, words=9):
        word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randrange(2, 8)))
        return " ".join(" ".join(word() for _ in range(words)).capitalize() + stop for _ in range(sentences))

    latin = "abcdefghijklm"
    scripts = [("ابتثجحخدذ", "."), ("אבגדהוזחט", "."), ("कखगघचछजिी", "।"), ("가나다라마바", "."), ("กขคงจฉช", ""),
               ("あいうえ日本語", "。"), ("ሀለሐመሠረሰ", "።"), ("абвгдежз", ".")]
    rows = [(i, clean(latin, ".", rng.randrange(2, 30))) for i in range(400)]
    rows += [(500 + i, clean(latin, ".", 20).upper().replace(" ", "!! ")) for i in range(40)]
    rows += [(600 + i, clean(latin, "", 20)) for i in range(40)]
    rows += [(700 + i, clean(*scripts[i % 8], n)) for i, n in enumerate([2] * 8 + [12] * 8 + [60] * 8)]
    rows += [(800, clean(latin, ".", 5, 60)), (801, clean(latin, ".", 3, 90)), (802, "1234 5678 " * 20 + "日本")]
    docs = docs_table(rows)
    m = measured(docs)
    got = {r.doc_id: r.s for r in m.select("doc_id", score(fit(m), F.col("m")).alias("s")).collect()}
    assert all(got[i].kept and got[i].label > 0.5 for i in [*range(400), *range(700, 724), 800, 801])
    assert not any(got[i].kept for i in [*range(500, 540), *range(600, 640), 802])


def test_sample_is_of_distinct_ids(spark, docs_table, monkeypatch):
    from concord.llm import weak

    docs = docs_table([(7, "The same text again. It is short.")] * 300 + [(i, f"Text number {i} is here. Fine.") for i in range(20, 60)])
    seen, was = [], weak.train
    monkeypatch.setattr(weak, "train", lambda rows, *a, **o: (seen.append((len(rows), o["times"].sum())), was(rows, *a, **o))[1])
    weak.fit(measured(docs), sample=41)
    assert seen == [(41, 340.0)]


def test_posteriors_by_enumerating_patterns():
    from itertools import product

    from concord.llm.weak import LabelModel
    rng = np.random.default_rng(5)
    vote = rng.random((len(LABELLERS), 2, 3)) + 0.05
    vote /= vote.sum(axis=2, keepdims=True)
    model = LabelModel(0.7, vote)
    patterns = list(product(range(3), repeat=len(LABELLERS)))[::37]
    numbers = np.array([int("".join(map(str, p)), 3) for p in patterns])
    for p, got in zip(patterns, posterior(model, numbers)):
        bad, good = 0.3, 0.7
        for j, v in enumerate(p):
            bad, good = bad * vote[j, 0, v], good * vote[j, 1, v]
        assert abs(got - good / (good + bad)) < 1e-9


def test_accepted_rows_are_those_the_scorer_keeps(spark, docs_table):
    from concord.llm.weak import accepted
    rng = random.Random(3)
    clean = lambda: ". ".join(" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(8)).capitalize() for _ in range(9)) + "."
    docs = docs_table([(i, clean()) for i in range(200)] + [(500 + i, clean().upper().replace(" ", "!!### ")) for i in range(20)] + [(900, None), (3, clean())])
    m = measured(docs)
    model = fit(m)
    want = sorted((r.doc_id, r.text) for r in docs.filter(score(model, measure(F.col("text")))["kept"]).collect())
    got = accepted(docs)
    assert got.columns == docs.columns and sorted((r.doc_id, r.text) for r in got.collect()) == want and len(want) >= 190
