"""Quality rules, usage filters, sync/migration helpers and catalogue flattening."""

import pytest
from pyspark.sql import functions as F

from concord.operators import quality as QY
from concord.operators import sync as SY
from concord.operators import usage as U
from concord.session import scratch_path
from concord.sources import catalog as CT
from concord.sources import readers as RD
from concord.sources import sinks as SK


def test_expectation_actions(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = {"positive": F.col("x") > 0}
    assert QY.apply_expectations(df, rules, "warn").where(~F.col("_valid")).count() == 2  # NULL fails
    assert QY.apply_expectations(df, rules, "drop").count() == 1
    with pytest.raises(Exception):
        QY.apply_expectations(df, rules, "fail").collect()
    ok, bad = QY.quarantine(df, rules)
    assert ok.count() == 1 and [list(r.failed_rules) for r in bad.collect()] == [["positive"], ["positive"]]


def test_measure_parity_streak(spark):
    l = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 10.0)], "p int, v double")
    r = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 12.0)], "p int, v double")
    out = {x.period: (x.within_tolerance, x.clean_streak)
           for x in QY.measure_parity(l, r, "p", {"v": F.sum("v")}, tolerance_pct=1.0).collect()}
    assert out == {1: (True, False), 2: (True, True), 3: (False, False)}


def test_usage_filter_modes(spark):
    df = spark.createDataFrame([("d1", None), ("d2", "sales"), ("d2", None)], "dataset_id string, dataset_name string")
    assert U.usage_filter(df, "dataset_id", "dataset_name", "d1").count() == 1
    assert U.usage_filter(df, "dataset_id", "dataset_name", "d1", mode="reference").count() == 2


def test_sync_helpers(spark):
    cat = spark.createDataFrame([("account", "AccountId", "uniqueidentifier", None, None, 1),
                                 ("account", "Balance", "money", None, None, 2),
                                 ("account", "Rate", "decimal", 10, 2, 3),
                                 ("contact", "Name", "nvarchar", None, None, 1),
                                 ("contact", "ParentId", "int", None, None, 2)], CT.CATALOGUE_SCHEMA)
    cfg = {r.sync_table_name: r for r in SY.sync_config(cat, "lake.raw").collect()}
    assert cfg["accounts"].primary_key_column == "accountid"
    assert cfg["contacts"].primary_key_column == "parentid"
    assert cfg["accounts"].phantom_row_sql == ("SELECT CAST(NULL AS STRING) AS accountid, CAST(NULL AS DECIMAL(19,4)) AS "
                                               "balance, CAST(NULL AS DECIMAL(10,2)) AS rate WHERE 1=0")
    assert spark.sql(cfg["accounts"].phantom_row_sql).count() == 0
    e = SY.empty_typed(spark, [("a", "bigint"), ("b", "decimal(10,2)")])
    assert e.count() == 0 and e.schema.simpleString() == "struct<a:bigint,b:decimal(10,2)>"


def test_migration_statuses(spark):
    good = spark.createDataFrame([(1, float("nan"))], "a int, b double")
    empty_cols = spark.range(1).select()
    bad = spark.createDataFrame([("x",)], "a string")
    rep = SY.migrate_tables(spark, {"good": good, "nocols": empty_cols, "bad": bad}, scratch_path(spark, "mig"),
                            types={"bad": {"a": "not_a_type"}})
    st = {r.table_name: (r.status, r.rows) for r in rep.collect()}
    assert st["good"] == ("ok", 1) and st["nocols"] == ("skipped", 0) and st["bad"][0] == "error"


def test_entity_metadata_flatten(spark):
    raw = spark.createDataFrame([("b", {"UserLocalizedLabel": {"Label": "B"}}, "bs", True),
                                 ("a", None, "as", False), ("c", None, None, False)],
                                "LogicalName string, DisplayName struct<UserLocalizedLabel: struct<Label: string>>, "
                                "EntitySetName string, IsCustomEntity boolean")
    got = [(r.logical_name, r.display_name) for r in CT.entity_metadata(raw).collect()]
    assert got == [("a", None), ("b", "B")]


def test_cli_reconcile(spark):
    from concord import cli
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    left = o.withColumnRenamed("o_custkey", "o_custkey_OLD").withColumn("META_LOAD", o.o_orderkey)
    rep = cli.reconcile(spark, left, o.drop("o_orderpriority"), [["o_orderkey"]], strip_suffix_regex="_OLD$",
                        drop_prefixes=["META"])
    assert rep["left_only_columns"] == ["O_ORDERPRIORITY"]
    assert rep["row_match"].collect()[0].exact_match
    assert {r.status for r in rep["schema"].collect()} == {"match", "left_only"}


def test_migration_of_empty_table_keeps_schema(spark):
    empty = spark.createDataFrame([], "a bigint, b string")
    root = scratch_path(spark, "mig-empty")
    rep = SY.migrate_tables(spark, {"e": empty}, root, types={"e": {"a": "int"}}).collect()[0]
    assert (rep.status, rep.rows) == ("ok", 0)
    back = spark.read.parquet(f"{root}/dev/e")
    assert back.count() == 0 and back.schema.simpleString() == "struct<a:int,b:string>"


def test_scalar_helpers(spark):
    import datetime as dt

    from concord.functions import scalars as SC
    df = spark.createDataFrame([("5-LOW", 20240131), ("no digits", 20241340), (None, None)], "p string, d int")
    got = [(r.k, r.dt) for r in df.select(SC.first_number(F.col("p")).alias("k"),
                                         SC.int_to_date(F.col("d")).alias("dt")).collect()]
    assert got == [(5, dt.date(2024, 1, 31)), (None, None), (None, None)]
    z = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8, 0), "0")], "t timestamp_ntz, z string")
    utc = z.select(SC.local_to_utc(F.col("t"), F.col("z"), {"0": "Australia/Perth"}).alias("u")).collect()[0].u
    assert utc == dt.datetime(2024, 1, 1, 0, 0)


def test_csv_keeps_every_value(spark):
    values = [None, "", " ", "\n", "a\nb", "a\r\nb", "\r", '"', '""', 'say "x", y', "  pad  ", "\\", "\\N", "\\\\N", "null", "#c", "é\t|", ",", "'"]
    df = spark.createDataFrame([(i, v, w) for i, v in enumerate(values) for w in (v, None, "x")], "i int, v string, w string")
    path = scratch_path(spark, "csv-values")
    SK.write_csv(df.repartition(3), path)
    got = RD.read_csv(spark, path, "i int, v string, w string")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_ranged_reload_keeps_rows_without_a_date(spark):
    from concord.operators import load as L
    t = spark.createDataFrame([(1, None), (2, 5), (3, 50)], "k int, d int")
    s = spark.createDataFrame([(9, 6), (8, None)], "k int, d int")
    assert sorted(r.k for r in L.ranged_reload(t, s, "d", F.lit(0), F.lit(10)).collect()) == [1, 3, 9]


def test_scd2_keeps_rows_without_a_current_flag(spark):
    from concord.operators import load as L
    h = L.scd2_initial(spark.createDataFrame([(1, "a")], "k int, v string"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    odd = h.withColumns({"k": F.lit(7), "is_current": F.lit(None).cast("boolean")})
    out = L.scd2(h.unionByName(odd), spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], ["v"],
                 F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00")))
    assert sorted((r.k, r.is_current) for r in out.collect()) == [(1, True), (7, None)]


def test_key_gap_counts_rows_without_a_key(spark):
    from concord.operators import drilldown as DD
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (None, "z")], "k int, v string")
    row = DD.key_gap(left, right, ["k"], ["v"]).first()
    assert row.remainder_rows == left.join(right, "k", "left_anti").count() == 3 and row.remainder_distinct_v == 3
