from collections import defaultdict

import corpus_pipeline as P
from concord.llm.common import table
from concord.llm.decontaminate import plain
from test_jaccard import brute as classes
from test_suffix import brute as removed

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    kept = {}
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if name != "mixture":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    for d, q in labels.items():
        assert (d in kept["quality"]) == bool(q) or sum((x in kept["quality"]) != bool(y) for x, y in labels.items()) < 20
    first = classes([(d, r.text) for d, r in kept["quality"].items()])
    assert set(kept["near_copies"]) == {int(c) for _, _, c in first}
    want = {d: (n, gone, digest) for d, n, gone, _, digest in removed([(d, r.text) for d, r in kept["near_copies"].items()])}
    assert set(kept["repeats"]) == set(kept["near_copies"])
    for d, r in kept["repeats"].items():
        n, gone, _ = want[str(d)]
        assert n - gone <= len(r.text.encode()) <= n - gone + 6 * (gone > 0) * n // 100 + 6 and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[d].lang, before[d].source)
        if not gone:
            assert r.text == before[d].text
    items = [plain(r.text) for r in table(spark, SF, "benchmark").collect()]
    leaky = {d for d, r in kept["repeats"].items() if any(i in plain(r.text) for i in items)}
    assert leaky and set(kept["benchmark"]) == set(kept["repeats"]) - leaky
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(kept["benchmark"])
    taken, target = defaultdict(int), {}
    for r in rows:
        assert r.taken == r.copies * r["size"] <= 2 * r["size"] and r["size"] == len(kept["benchmark"][r.doc_id].text.split())
        taken[r.source] += r.taken
        target[r.source] = r.target
    most = max(r["size"] for r in rows)
    assert all(abs(taken[s] - target[s]) <= most for s in target)


def test_odd_rows_pass_through(spark, docs_table):
    good = ". ".join("Some plain words make up this sentence number %d of a text" % i for i in range(30)) + "."
    rows = [(1, good), (1, good), (None, good + " More of it."), (2, None), (3, ""), (4, "Short. But fine."),
            (None, None), (5, "Other words " + good[::-1].capitalize())]
    docs = docs_table(rows)
    for _, stage in P.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    ids = sorted(str(r.doc_id) for r in docs.collect())
    assert ids == ["1", "2", "3", "4", "5", "None"]
    assert P.mixture(spark, docs, SF).count() == 6


def test_empty_table(spark, docs_table):
    docs = docs_table([])
    for _, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = docs if out.columns != docs.columns else out
