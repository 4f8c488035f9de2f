"""Hand-made edge sets for the reconciliation operators (NULLs, multisets, empty sides, floats, strings, types)."""

import pytest
from pyspark.sql import functions as F

from concord.functions import types as TY
from concord.operators import compare as C


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_nulls_do_not_collide(spark):
    l = spark.createDataFrame([(None, "a")], "x string, y string")
    r = spark.createDataFrame([("a", None)], "x string, y string")
    m = one(C.row_match(l, r))
    assert m["matched_rows"] == 0 and m["only_left_rows"] == 1 and m["only_right_rows"] == 1


def test_null_equals_null_in_row_compare(spark):
    l = spark.createDataFrame([(None, "a"), (None, None)], "x string, y string")
    m = one(C.row_match(l, l))
    assert m["matched_rows"] == 2 and m["exact_match"]


@pytest.mark.parametrize("method", ["hash", "exact"])
def test_multiset(spark, method):
    l = spark.createDataFrame([("x",), ("x",), ("y",)], "v string")
    r = spark.createDataFrame([("x",), ("z",)], "v string")
    m = one(C.row_match(l, r, method=method))
    assert (m["matched_rows"], m["only_left_rows"], m["only_right_rows"]) == (1, 2, 1)
    s = one(C.row_match_set_ops(l, r, ["v"]))
    assert (s["matched_rows"], s["only_left_rows"], s["only_right_rows"]) == (1, 2, 1)


def test_empty_sides(spark):
    e = spark.createDataFrame([], "v string")
    x = spark.createDataFrame([("a",)], "v string")
    both = one(C.row_match(e, e))
    assert both["pct_of_left"] == 100.0 and both["pct_of_right"] == 100.0 and both["exact_match"]
    le = one(C.row_match(e, x))
    assert le["pct_of_left"] == 100.0 and le["pct_of_right"] == 0.0
    rc = one(C.row_counts(e, x))
    assert rc["row_diff_pct"] == 0.0 and rc["row_diff"] == 1


def test_negative_zero_and_rounding(spark):
    l = spark.createDataFrame([(0.0, 1.0000001)], "a double, b double")
    r = spark.createDataFrame([(-0.0, 1.0000002)], "a double, b double")
    base = {row.scenario: row for row in C.row_match_scenarios(l, r).collect()}
    assert base["baseline"].matched_rows == 0
    assert base["round_float_6dp"].matched_rows == 1
    a = spark.createDataFrame([(0.0,)], "a double")
    b = spark.createDataFrame([(-0.0,)], "a double")
    assert one(C.row_match(a, b))["matched_rows"] == 1


def test_string_scenarios(spark):
    l = spark.createDataFrame([("abc ", "x"), ("", "y")], "s string, t string")
    r = spark.createDataFrame([("ABC", "x"), (None, "y")], "s string, t string")
    sc = {row.scenario: row for row in C.row_match_scenarios(l, r).collect()}
    assert sc["trim_strings"].matched_rows == 0
    assert sc["trim_upper_strings"].matched_rows == 1  # empty string never equals NULL


def test_right_dedup_scenario(spark):
    l = spark.createDataFrame([("a",)], "s string")
    r = spark.createDataFrame([("a",), ("a",)], "s string")
    sc = {row.scenario: row for row in C.row_match_scenarios(l, r).collect()}
    assert sc["baseline"].only_right_rows == 1 and sc["right_deduped"].exact_match


def test_key_nulls_never_match(spark):
    l = spark.createDataFrame([(None, 1), (1, 1)], "k int, v int")
    r = spark.createDataFrame([(None, 1), (1, 1), (1, 2)], "k int, v int")
    d = one(C.key_diagnostics(l, r, [["k"]]))
    assert d["keys_only_in_left"] == 1 and d["keys_only_in_right"] == 1
    assert d["keys_where_right_has_more_rows"] == 1 and d["extra_right_rows_by_key_multiplicity"] == 1


def test_duplicates_and_histogram(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "s string")
    p = one(C.duplicate_profile(df))
    assert p["duplicate_rows"] == 2 and p["distinct_rows"] == 2
    h = {r.copies: r.distinct_rows for r in C.copies_histogram(df).collect()}
    assert h == {3: 1, 1: 1}


def test_type_maps(spark):
    from pyspark.sql import functions as F

    pairs = spark.createDataFrame(
        [("NVARCHAR(100)", "STRING", True), ("smallint", "INT", True), ("INT", "BIGINT", False),
         ("VARCHAR", "GEOGRAPHY", None), ("DECIMAL", "DECIMAL(18,2)", True)], "l string, r string, ok boolean")
    allowed = TY.type_map_column()[TY.base_type_col(F.col("r"))]  # unknown types have no entry: reported (N2)
    got = pairs.select(F.array_contains(allowed, TY.base_type_col(F.col("l"))).alias("m"), "ok").collect()
    assert all(r.m == r.ok for r in got)
    types = spark.createDataFrame([("money", None, None), ("numeric", 10, None), ("hierarchyid", None, None)],
                                  "t string, p int, s int")
    ddl = [r.d for r in types.select(TY.left_to_right_ddl_col(F.col("t"), F.col("p"), F.col("s")).alias("d")).collect()]
    assert ddl == ["DECIMAL(19,4)", "DECIMAL(10,0)", "STRING"]


def test_schema_diff_statuses(spark):
    l = spark.createDataFrame([("A_OLD", "varchar"), ("B", "int"), ("C", "varchar"), ("D", "xml")],
                              "column_name string, data_type string")
    r = spark.createDataFrame([("A", "STRING"), ("B", "BIGINT"), ("E", "DATE"), ("D", "GEOGRAPHY")],
                              "column_name string, data_type string")
    st = {x.column_name: x.status for x in C.schema_diff(l, r, "_OLD$").collect()}
    assert st == {"A": "match", "B": "type_mismatch", "C": "left_only", "E": "right_only", "D": "type_mismatch"}


def test_scale_conf():
    from concord.session import scale_conf
    c = scale_conf(100 * 1024 ** 4)
    assert int(c["spark.sql.shuffle.partitions"]) == 819200
    assert scale_conf(10)["spark.sql.shuffle.partitions"] == "200"


def test_nan_and_non_finite(spark):
    from concord.functions import normalize as N
    l = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double")
    r = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double")
    assert one(C.row_match(l, r))["matched_rows"] == 2
    cleaned = N.null_non_finite(l).collect()
    assert all(row.x is None for row in cleaned)


def test_scan_formats(spark):
    from concord.sources import readers as RD
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").createOrReplaceTempView("scan_src")
    df = RD.scan(spark, "scan_src", "table", ["k"], "k > 1")
    assert [r.k for r in df.collect()] == [2]


def test_short_keys_are_grouped_by_their_values(spark):
    l = spark.createDataFrame([(1, 0.0, "a"), (1, -0.0, "a"), (None, 1.0, "b"), (2, float("nan"), None)], "k int, d double, s string")
    r = spark.createDataFrame([(1, 0.0, "a"), (None, 1.0, "b"), (2, float("nan"), None), (3, 3.0, "c")], "k long, d double, s string")
    out = C.key_diagnostics(l, r, [["k", "d"], ["k"]])
    assert "xxhash64" not in out._jdf.queryExecution().toString()
    got = {x.key_name: list(x)[1:] for x in out.collect()}
    assert got == {"k + d": [3, 4, 1, 2, 1, 0, 0, 0], "k": [3, 4, 1, 2, 1, 0, 0, 0]}
    mixed = C.key_diagnostics(l, r, [["k", "s"]])
    assert list(one(mixed).values())[1:] == [3, 4, 2, 3, 1, 0, 0, 0]
    text = r.withColumn("k", F.col("k").cast("string"))  # values of other types never match
    assert list(one(C.key_diagnostics(l, text, [["k"]])).values())[1:5] == [3, 4, 3, 4]
    assert C.key_diagnostics(l.limit(0), r.limit(0), [["k"]]).count() == 0
