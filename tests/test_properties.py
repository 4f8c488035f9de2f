"""Property tests: multiset totals vs a Python reference, merge replay, idempotent dedup."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from concord.operators import compare as C
from concord.operators import dedup as DU
from concord.operators import load as L

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])), max_size=12)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(left=rows_st, right=rows_st)
def test_row_match_equals_counter(spark, left, right):
    sch = "s string, n int"
    m = C.row_match(spark.createDataFrame(left, sch), spark.createDataFrame(right, sch)).collect()[0]
    cl, cr = Counter(left), Counter(right)
    assert m.matched_rows == sum((cl & cr).values())
    assert m.only_left_rows == sum((cl - cr).values())
    assert m.only_right_rows == sum((cr - cl).values())
    assert m.exact_match == (cl == cr)


@SETTINGS
@given(target=st.dictionaries(st.integers(0, 6), st.sampled_from(["x", "y"]), max_size=6),
       source=st.dictionaries(st.integers(0, 6), st.sampled_from(["x", "y"]), max_size=6))
def test_full_merge_replay(spark, target, source):
    sch = "k int, v string"
    t = spark.createDataFrame(sorted(target.items()), sch)
    s = spark.createDataFrame(sorted(source.items()), sch)
    new, changes = L.full_merge(t, s, ["k"])
    ch = [(r.k, r.v, r._change_type) for r in changes.collect()]
    state = Counter(target.items())
    state -= Counter((k, v) for k, v, c in ch if c == "delete")
    state += Counter((k, v) for k, v, c in ch if c == "insert")
    assert state == Counter(source.items()) == Counter((r.k, r.v) for r in new.collect())


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["p", "q"]), st.integers(0, 5)), max_size=10))
def test_dedup_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "s string, t int")
    from pyspark.sql import functions as F
    once = DU.drop_exact_duplicates(df, ["s"], newest=F.col("t"))
    twice = DU.drop_exact_duplicates(once, ["s"], newest=F.col("t"))
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    assert a == sorted((s, max(t for s2, t in rows if s2 == s)) for s in {r[0] for r in rows})
