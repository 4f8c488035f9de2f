"""Searches: causes of a gap, composite keys, and stored fingerprint trees."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from concord.operators import compare as C
from concord.operators import drilldown as DD
from concord.operators import fingerprints as FP
from concord.session import scratch_path


def rows(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice("abcd"), rng.choice("xyz"), rng.choice([None, "p", "q"]), rng.randrange(40)) for i in range(n)]


SCHEMA = "id long, a string, b string, c string, d int"


def causes(spark, data, lost, **kw):
    left = spark.createDataFrame(data, SCHEMA)
    right = spark.createDataFrame([r for r in data if not lost(r)], SCHEMA)
    return DD.gap_causes(left, right, ["id"], ["a", "b", "c", "d"], **kw).orderBy("place").collect()


def test_planted_cause_of_two_columns_comes_first(spark):
    got = causes(spark, rows(3000, 1), lambda r: (r[1], r[3]) == ("b", None) or r[0] % 100 == 0)
    assert got[0].cause == "a=b & c=NULL" and got[0].precision == 1.0 and got[0].support > 0.8
    assert got[0].place == 1 and all(x.f1 >= y.f1 for x, y in zip(got, got[1:]))


def test_planted_cause_of_three_columns(spark):
    got = causes(spark, rows(4000, 2), lambda r: r[1:4] == ("c", "x", "q"), max_columns=3)
    assert got[0].cause == "a=c & b=x & c=q" and got[0].risk_ratio is None and got[0].support == 1.0


def test_the_search_loses_nothing_to_pruning(spark):
    data = rows(600, 3)
    lost = lambda r: (r[1] == "a" and random.Random(r[0]).random() < 0.6) or random.Random(-r[0] - 1).random() < 0.1
    got = {x.cause: (x.missing, x.present) for x in causes(spark, data, lost, min_support=0.1, min_ratio=1.5)}
    want = {}
    total = sum(map(lost, data))
    for k in (1, 2):
        for s in combinations(range(4), k):
            groups = {}
            for r in data:
                g = groups.setdefault(tuple("NULL" if r[1 + i] is None else str(r[1 + i]) for i in s), [0, 0])
                g[not lost(r)] += 1
            for v, (o, i) in groups.items():
                out, rest = total - o, len(data) - o - i
                if o >= 0.1 * total and (not out or (o / (o + i)) / (out / rest) >= 1.5):
                    want[" & ".join(f"{'abcd'[j]}={x}" for j, x in zip(s, v))] = (o, i)
    assert got == want and len(want) > 3


def test_no_gap_has_no_cause(spark):
    assert causes(spark, rows(50, 4), lambda r: False) == []


def test_null_keys_are_missing(spark):
    left = spark.createDataFrame([(None, "n"), (1, "y"), (2, "y")], "id long, a string")
    assert [r.cause for r in DD.gap_causes(left, left, ["id"], ["a"]).collect()] == ["a=n"]


def brute_keys(data, cols, most):
    keys = []
    for k in range(1, most + 1):
        for s in combinations(range(len(cols)), k):
            if any(set(x) <= set(s) for x in keys) or any(r[i] is None for r in data for i in s):
                continue
            if data and len({tuple(r[i] for i in s) for r in data}) == len(data):
                keys.append(s)
    return sorted(",".join(cols[i] for i in s) for s in keys)


def test_composite_keys_equal_brute_force(spark):
    cols = ["a", "b", "c", "d", "e"]
    for seed in range(4):
        rng = random.Random(seed)
        data = [(i // 6, i % 6, rng.randrange(9), None if seed == 1 and i == 5 else i, rng.randrange(3)) for i in range(36)]
        if seed == 2:
            data.append(data[0])
        df = spark.createDataFrame(data, "a int, b int, c int, d int, e int")
        got = sorted(r.key_columns for r in C.composite_keys(df, cols).collect())
        assert got == brute_keys(data, cols, 3)
    assert C.composite_keys(df.limit(0), cols).count() == 0


def test_fingerprint_tree_reads_what_differs(spark):
    df = spark.createDataFrame([(i, f"v{i % 50}") for i in range(5000)] + [(1, "copy")] * 40, "i int, v string")
    changed = df.where("i <> 77").unionByName(df.where("i = 4000")).withColumn("v", F.when(F.col("i") == 9, "new").otherwise(F.col("v")))
    roots = {k: scratch_path(spark, f"fp-{k}") for k in ("a", "b", "same", "none")}
    for k, d in (("a", df), ("b", changed), ("same", df.repartition(3)), ("none", df.limit(0))):
        FP.store(d, ["i", "v"], roots[k])
    row = FP.match_stored(spark, roots["a"], roots["b"]).first()
    want = C.row_match(df, changed, ["i", "v"]).first()
    assert [row[c] for c in ("left_rows", "right_rows", "matched_rows", "only_left_rows", "only_right_rows")] == [
        want[c] for c in ("left_rows", "right_rows", "matched_rows", "only_left_rows", "only_right_rows")]
    assert 1 <= row.leaves_read <= 4  # 4 changed rows of 256 ranges
    same = FP.match_stored(spark, roots["a"], roots["same"]).first()
    assert same.leaves_read == 0 and same.matched_rows == same.left_rows == 5040
    empty = FP.match_stored(spark, roots["a"], roots["none"]).first()
    assert (empty.right_rows, empty.matched_rows, empty.only_left_rows) == (0, 0, 5040)


def test_composite_keys_hold_few_sets_against_all_rows(spark, monkeypatch):
    asked = []
    real = C._repeated
    monkeypatch.setattr(C, "_repeated", lambda df, sets, share: asked.append((share, list(sets))) or real(df, sets, share))
    df = spark.range(6000).select((F.col("id") / 6).cast("int").alias("a"), (F.col("id") % 6).alias("b"), (F.col("id") / 3).cast("int").alias("c"))
    assert [r.key_columns for r in C.composite_keys(df, ["a", "b", "c"]).collect()] == ["a,b", "b,c"]
    assert [s for share, sets in asked if share == 1 for s in sets] == [("b",), ("a", "b"), ("b", "c")]


def test_one_repeat_is_found_whatever_its_fingerprint(spark):
    for twice in range(5):  # one value in 64 is looked at first, all of them after that
        df = spark.range(300).select(F.when(F.col("id") == 299, twice).otherwise(F.col("id")).alias("a"))
        assert C.composite_keys(df, ["a"]).count() == 0
    assert C.composite_keys(spark.range(300), ["id"]).count() == 1
