"""Profiles and drill-down: nearest quantiles, mode ties, month-end windows, yearly gaps."""

import datetime as dt

from pyspark.sql import functions as F

from concord.operators import drilldown as DD
from concord.operators import profile as P


def test_nearest_quantile_rule(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    r = P.nearest_quantiles(df, (0.25, 0.75)).collect()[0]
    # index round(3 * .25) = round(0.75) = 1 -> second element; percentile_disc would give the first
    assert r.q_0 == 2.0 and r.q_1 == 3.0 and r.median == 2.5


def test_quantiles_with_hot_value(spark):
    rows = [(5.0,)] * 500 + [(float(i),) for i in range(10)]
    r = P.nearest_quantiles(spark.createDataFrame(rows, "v double"), (0.0, 0.5, 1.0)).collect()[0]
    assert (r.q_0, r.q_1, r.q_2) == (0.0, 5.0, 9.0)


def test_mode_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    r = P.string_profile(df).collect()[0]
    assert r["mode"] == "a" and r["null_count"] == 1 and r["n_unique"] == 2


def test_month_end_window(spark):
    d = spark.createDataFrame([(dt.datetime(2024, 3, 31),), (dt.datetime(2024, 2, 29),), (dt.datetime(2024, 2, 28),)],
                              "d timestamp_ntz")
    l, r = DD.window_sample(d, d, "d", mode="independent")
    assert l.count() == 2  # one month back from 03-31 is 02-29
    assert r.count() == 1  # 30 days back is 03-01
    ls, rs = DD.window_sample(d, d, "d", mode="shared")
    assert ls.count() == rs.count() == 2


def test_yearly_counts_null_pct(spark):
    l = spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "d timestamp_ntz")
    r = spark.createDataFrame([(dt.datetime(2019, 1, 1),), (dt.datetime(2020, 1, 1),)], "d timestamp_ntz")
    y = {x.year: x for x in DD.yearly_counts(l, r, "d").collect()}
    assert y[2019].pct_diff is None and y[2019].left_rows == 0 and y[2020].diff == 0


def test_stats_of_dates_that_differ_below_a_second_do_not_match(spark):
    one = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 10_000),)], "t timestamp_ntz")
    two = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0, 999_999),)], "t timestamp_ntz")
    assert not P.column_stats_compare(one, two).collect()[0].stats_match
    assert P.column_stats_compare(one, one).collect()[0].stats_match


def test_guarded_join_of_unknown_members(spark):
    from concord.operators import load as L

    fact = spark.createDataFrame([(1, 5), (2, 6), (None, 7), (0, 8), (-1, 9), (99, 1)], "sk int, v int")
    dim = spark.createDataFrame([(1, "a"), (2, None), (0, "zero"), (-1, "neg"), (None, "none")], "sk int, name string")
    got = sorted((r.v, r.name) for r in L.guarded_dim_join(fact, dim, "sk", "sk", ["name"]).collect())
    assert got == [(1, "Unknown"), (5, "a"), (6, "Unknown"), (7, "Unknown"), (8, "Unknown"), (9, "Unknown")]


def test_column_stats_one_pass(spark):
    df = spark.createDataFrame([(1, "ab", None), (None, "abcd", dt.datetime(2024, 1, 1))],
                               "n int, s string, t timestamp_ntz")
    st = {r.column_name: r for r in P.column_stats(df).collect()}
    assert st["n"].nulls == 1 and st["n"].num_max == 1.0
    assert st["s"].len_min == 2 and st["s"].len_max == 4
    assert st["t"].date_min == "2024-01-01 00:00:00.000000"


def test_column_stats_read_the_input_once(spark, tmp_path):
    path = str(tmp_path / "wide")
    row = {f"c{j}": (lambda i, j=j: [i % 3, f"s{i % 5}", float(i % 7), None][j % 4]) for j in range(23)}
    spark.createDataFrame([tuple(f(i) for f in row.values()) for i in range(60)],
                          ", ".join(f"c{j} {('int', 'string', 'double', 'date')[j % 4]}" for j in range(23))).write.parquet(path)
    df = spark.read.parquet(path)
    st = P.column_stats(df)
    got = {r.column_name: (r.distinct_values, r.nulls) for r in st.collect()}
    assert got == {f"c{j}": ((3, 5, 7, 0)[j % 4], (0, 0, 0, 60)[j % 4]) for j in range(23)}
    assert st._jdf.queryExecution().optimizedPlan().toString().count("] parquet") == 1
    empty = {r.column_name: (r.distinct_values, r.nulls, r.num_avg) for r in P.column_stats(df.limit(0)).collect()}
    assert set(empty.values()) == {(0, 0, None)} and len(empty) == 23
    plain = df.agg(*[F.avg("c0"), F.max("c2"), F.min(F.length("c1"))]).first()
    c = {r.column_name: r for r in st.collect()}
    assert (c["c0"].num_avg, c["c2"].num_max, c["c1"].len_min) == tuple(plain)


def test_distinct_counts_agree(spark):
    df = spark.createDataFrame([(i % 3, f"s{i % 5}", float(i % 7)) for i in range(50)], "a int, b string, c double")
    exact = {r.column_name: r.distinct_values for r in P.column_stats(df).collect()}
    assert exact == {"a": 3, "b": 5, "c": 7}
    approx = {r.column_name: r.distinct_values for r in P.column_stats(df, distinct="approx").collect()}
    assert approx == {"a": 3, "b": 5, "c": 7}


def test_grouped_median_hot_group(spark):
    rows = [("hot", float(i % 11)) for i in range(3000)] + [("odd", 1.0), ("odd", 5.0), ("odd", 3.0),
                                                           ("even", 1.0), ("even", 4.0), ("nul", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    m = {r.g: r.median for r in P.grouped_median(df, ["g"], "v").collect()}
    import statistics
    assert m["hot"] == statistics.median([float(i % 11) for i in range(3000)])
    assert m["odd"] == 3.0 and m["even"] == 2.5 and "nul" not in m


def test_profiles_all_null_and_many_columns(spark):
    df = spark.createDataFrame([(None, 1.0, 10), (None, 3.0, 20), (None, None, 30)], "s string, a double, b int")
    sp = {r.column_name: r for r in P.string_profile(df).collect()}
    assert sp["s"].n_unique == 0 and sp["s"].mode is None and sp["s"].null_count == 3 and sp["s"].len_q1 is None
    npf = {r.column_name: r for r in P.numeric_profile(df).collect()}
    assert npf["a"].median == 2.0 and npf["a"].null_count == 1 and npf["b"].q1 == 20.0 and npf["b"].q3 == 30.0  # round(0.5) = 1, round(1.5) = 2


def test_numbers_and_times_are_counted_by_themselves(spark):
    df = spark.createDataFrame([(1, 0.0, 1.5, None), (1, -0.0, None, "2024-01-02"), (None, float("nan"), 1.5, "2024-01-02"),
                                (2 ** 53 + 1, float("nan"), 2.5, "2024-01-01")], "k long, d double, f float, t string")
    df = df.withColumn("t", F.col("t").cast("date"))
    assert "xxhash64" not in P.column_stats(df)._jdf.queryExecution().toString()
    st = {r.column_name: r for r in P.column_stats(df).collect()}
    assert {c: (r.distinct_values, r.nulls) for c, r in st.items()} == {"k": (2, 1), "d": (2, 0), "f": (2, 1), "t": (2, 1)}
    assert (st["k"].num_min, st["k"].num_max, st["f"].num_avg) == (1.0, float(2 ** 53 + 1), 5.5 / 3)
    assert (st["t"].date_min[:10], st["t"].date_max[:10]) == ("2024-01-01", "2024-01-02")
