import tracemalloc
from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from concord.llm.queries import QUERIES
from concord.llm import toxicity
from concord.llm.toxicity import (Rows, build_index, fit, isotonic, matrix, nearest, score, terms_of, unit_rows,
                                  vector_column)

SF = "/root/testdata/sf0.01"


def test_neighbours_are_exact():
    rng = np.random.default_rng(5)
    idf = 1 + rng.random(40) * 5

    def vectors(n):
        out = []
        for _ in range(n):
            t = np.sort(rng.choice(40, size=rng.integers(1, 6), replace=False)).tolist()
            out.append((t, rng.integers(1, 4, size=len(t)).tolist()))
        return out

    x, q = matrix(vectors(700), idf), matrix(vectors(150), idf)
    ids = rng.permutation(10_000)[:700]
    index = build_index(ids, np.zeros(700, int), x)
    top, who = nearest(index, q, 15)
    full = np.round(q @ x.T, 12)
    for i in range(len(q)):
        want = sorted(((-c, d) for c, d in zip(full[i], ids) if c > 1e-9))[:15]
        got = [(-c, index.ids[w]) for c, w in zip(top[i], who[i]) if w >= 0]
        assert [w[1] for w in want] == [g[1] for g in got]
        assert np.allclose([w[0] for w in want], [g[0] for g in got], atol=1e-9)


def test_isotonic_rises():
    x, y = isotonic(np.array([3.0, 1, 2, 4, 4]), np.array([1.0, 1, 0, 0, 1]), np.ones(5))
    assert (np.diff(y) >= 0).all() and np.isclose(np.interp(1.5, x, y), 0.5)


def test_held_out_accuracy(spark):
    out = QUERIES["op1_toxicity_knn"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    held = out.filter("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    toxic = [r for r in held if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert all(0 <= r.score <= 1 for r in held)


def test_edge_cases(spark, docs_table):
    rows = [(i, f"word{i % 13} other{i % 7} " + ("scoundrel rogue" if i % 4 == 0 else "fine day")) for i in range(400)]
    rows += [(900, None), (901, ""), (902, "!!!"), (903, "scoundrel " * 50_000), (904, "you rogue"), (904, "you rogue"),
             (None, "rogue scoundrel"), (905, "fine day")]
    docs = docs_table(rows)
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 7) for i in range(400)] + [(0, 0, 7), (None, 1, 7), (3, None, 7)],
                                   "doc_id long, toxic int, score int")
    model, rows = fit(docs, labels)
    got = {}
    for r in rows.select("doc_id", score(model, F.col("v")).alias("s")).collect():
        got.setdefault(r.doc_id, []).append(r.s.score)
    assert all(v >= 0.9 for v in got[903] + got[904] + got[None]) and len(got[904]) == 2
    assert got[905][0] <= 0.1 and got[900] == got[901] == got[902] == [model.no_term]
    new = docs.select(score(model, vector_column(model.vocabulary, F.lit("some rogue"))).alias("s")).first().s
    assert new.score >= 0.9 and len(new.neighbours) == 15 and set(new.neighbour_labels) == {1}
    empty, rows = fit(docs, labels.limit(0))
    assert {r.s.score for r in rows.select(score(empty, F.col("v")).alias("s")).collect()} == {0.0}
    nothing, rows = fit(docs.limit(0), labels)
    assert rows.select(score(nothing, F.col("v"))).count() == 0


def test_every_example_and_every_term_counts(spark, docs_table):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    rows = [(i, " ".join(word() for _ in range(12))) for i in range(120)]  # no term tells the labels apart
    docs = docs_table(rows + [(1000 + i, t) for i, t in rows])  # exact copies, not labelled
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(120)], "doc_id long, toxic int")
    model, vectors = fit(docs, labels)
    assert set(model.index.ids) == set(range(120))
    for r in vectors.select("doc_id", score(model, F.col("v")).alias("s")).collect():
        assert r.s.neighbours[0] == r.doc_id % 1000 and np.isclose(r.s.cosines[0], 1.0) and r.s.n_terms >= 12


def test_vectors_hold_the_terms_of_the_text(spark):
    texts = ["Rotten rotten rottenness of a rotter, rotten!", "word " * 300 + "words wordy", None, "", "words"]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*map(terms_of, texts))))}
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    names = list(vocabulary)
    for r in table.select("text", vector_column(vocabulary, F.col("text")).alias("v")).collect():
        assert {names[t]: n for t, n in zip(r.v.terms, r.v.counts)} == terms_of(r.text)


def test_examples_are_weighed_without_copies_of_all_entries():
    """The driver holds the entries of all examples: 36 bytes an entry were taken to weigh them, the rows have 12."""
    import tracemalloc
    rng = np.random.default_rng(1)
    terms = [np.sort(rng.choice(50_000, 400, replace=False)).astype(np.int32) for _ in range(1500)]
    counts = [rng.integers(1, 5, 400).astype(np.int32) for _ in terms]
    idf = rng.random(50_000) + 1.0
    tracemalloc.start()
    rows = unit_rows(terms, counts, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 * len(rows.term)
    for i in (0, 255, 256, 1499):
        w = (1.0 + np.log(counts[i])) * idf[terms[i]]
        part = slice(rows.start[i], rows.start[i + 1])
        assert (rows.term[part] == terms[i]).all() and np.allclose(rows.weight[part], w / np.sqrt((w * w).sum()), rtol=1e-12)


def test_postings_are_summed_for_a_few_queries_at_a_time():
    rng = np.random.default_rng(4)
    m, width, each = 3000, 4000, 400
    term = np.concatenate([np.sort(rng.choice(width, each, replace=False)) for _ in range(m)]).astype(np.int32)
    rows = Rows(np.arange(m + 1) * each, term, rng.random(m * each), width)
    index = build_index(np.arange(m), np.arange(m) % 2, rows)
    index = replace(index, column=np.full(width, -1, dtype=np.int32), common=np.zeros((m, 0)), maxima=np.zeros((47, 0)),
                    start=np.append(0, np.cumsum(np.bincount(term, minlength=width))),
                    at=np.repeat(np.arange(m, dtype=np.int32), each)[np.argsort(term, kind="stable")],
                    weight=rows.weight[np.argsort(term, kind="stable")], ids=np.arange(m))
    queries = rows.take(np.arange(32))
    tracemalloc.start()
    top, who = nearest(index, queries, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    dense = np.zeros((m, width))
    dense[np.repeat(np.arange(m), each), term] = rows.weight
    cosine = dense[:32] @ dense.T
    assert np.allclose(top, -np.sort(-cosine, axis=1)[:, :5])
    assert peak < 50e6  # 32 queries have 3.8 million postings: 124 MB when they were summed at once


def test_a_task_scores_its_texts_in_one_python_worker(spark, docs_table):
    """Two workers a task held the vocabulary and the index, and all terms of a batch went from one to the other."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["rogue", "rogues", "rogueish", "fine", "finery", "day"], 9)) for _ in range(300)]
    docs = docs_table(list(enumerate(texts)) + [(900, None), (901, ""), (902, "rogue " * 300_000), (None, "rogue")])
    model, rows = fit(docs, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int"))
    whole = rows.select("doc_id", toxicity.score_text(model, F.col("text")).alias("s"))
    assert whole._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    steps = rows.select("doc_id", score(model, F.col("v")).alias("s"))
    key = lambda r: (r.doc_id is None, r.doc_id)
    assert sorted(whole.collect(), key=key) == sorted(steps.collect(), key=key) and whole.count() == 304
    out = QUERIES["op1_toxicity_knn"](spark, "/root/testdata/sf0.001")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_postings_of_a_long_text_are_summed_in_parts():
    """All postings of four texts were summed at once: a text with all terms has as many as the index."""
    rng = np.random.default_rng(6)
    m, width, each = 3000, 50_000, 400
    term = np.concatenate([np.sort(rng.choice(width, each, replace=False)) for _ in range(m)]).astype(np.int32)
    index = build_index(np.arange(m), np.arange(m) % 2, Rows(np.arange(m + 1) * each, term, rng.random(m * each), width))
    query = Rows(np.arange(5) * width, np.tile(np.arange(width, dtype=np.int32), 4), rng.random(4 * width), width)
    tracemalloc.start()
    top, who = nearest(index, query, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for weight, best in zip(query.weight.reshape(4, width), top):
        cosine = np.bincount(index.at, index.weight * np.repeat(weight, np.diff(index.start)), m)
        assert np.allclose(best, -np.sort(-cosine)[:5])
    assert peak < 40e6  # 4.8 million postings: 190 MB


def test_words_seen_are_bounded(monkeypatch):
    texts = [f"rotten{i % 7} word{i} rotten{i % 7} x{i}y" for i in range(400)] + [None, ""]
    names = sorted(set().union(*map(terms_of, texts[::3])))
    monkeypatch.setattr(toxicity, "TEXTS_AT_ONCE", 10)
    monkeypatch.setattr(toxicity, "MOST_SEEN", 50)
    reader = toxicity.Reader(toxicity.Terms({t: i for i, t in enumerate(names)}))
    got, most = [], 0
    for start, term, n in reader.pieces(texts):
        got += [{names[t]: k for t, k in zip(term[a:b], n[a:b])} for a, b in zip(start[:-1], start[1:])]
        most = max(most, len(reader.seen))
    known = set(names)
    assert got == [{t: k for t, k in terms_of(text).items() if t in known} for text in texts] and most <= 80
