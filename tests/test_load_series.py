"""Merges, change feeds, SCD2, time series, as-of, graph: hand-made edge sets and properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from concord.operators import dedup as DU
from concord.operators import events as EV
from concord.operators import fill as FL
from concord.operators import graph as G
from concord.operators import load as L
from concord.operators import timeseries as TS

T = dt.datetime


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_commit_ties_insert_wins(spark):
    feed = spark.createDataFrame([(1, "old", "delete", 2), (1, "new", "insert", 2), (2, "x", "insert", 1),
                                  (2, "x", "delete", 3), (3, "a", "insert", 1), (3, "a", "delete", 2),
                                  (3, "b", "insert", 4)],
                                 "k int, v string, _change_type string, _commit_version int")
    latest = DU.latest_change(feed, ["k"])
    assert rows(latest, "k", "v", "_change_type") == [(1, "new", "insert"), (2, "x", "delete"), (3, "b", "insert")]
    target = spark.createDataFrame([(1, "old"), (2, "x"), (4, "keep")], "k int, v string")
    out = L.delta_load(target, feed, ["k"], start_version=0)
    assert rows(out, "k", "v") == [(1, "new"), (3, "b"), (4, "keep")]


def test_hash_merge_replay(spark):
    t = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    s = spark.createDataFrame([("a",), ("c",), ("c",)], "v string")
    new, ch = L.hash_merge(t, s)
    assert rows(new, "v") == rows(s, "v")
    assert rows(ch, "v", "_change_type") == [("a", "delete"), ("b", "delete"), ("c", "insert"), ("c", "insert")]


def test_replicate_hot_row(spark):
    df = spark.createDataFrame([("hot", 10000), ("cold", 1)], "v string, n int")
    out = L.replicate(df, "n", chunk=1000)
    assert out.count() == 10001
    many_units = L.replicate(df, "n", chunk=7)  # units of 49 copies: the hot row spans 205 units
    assert many_units.count() == 10001 and many_units.where("v = 'hot'").count() == 10000


def test_full_merge_scoped_delete(spark):
    t = spark.createDataFrame([("A|1", 1), ("B|1", 1), ("A|2", 1)], "bk string, v int")
    s = spark.createDataFrame([("A|1", 2)], "bk string, v int")
    new, ch = L.full_merge(t, s, ["bk"], delete_scope=lambda col: col("bk").startswith("A|"))
    assert rows(new, "bk", "v") == [("A|1", 2), ("B|1", 1)]
    assert rows(ch, "bk", "v", "_change_type") == [("A|1", 1, "delete"), ("A|1", 2, "insert"), ("A|2", 1, "delete")]


def test_scd2_cases(spark):
    t0, t1 = T(2024, 1, 1), T(2024, 1, 2)
    cur = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, a string")
    hist = L.scd2_initial(cur, F.lit(t0).cast("timestamp_ntz"))
    snap = spark.createDataFrame([(1, "x"), (2, "Y"), (4, "w")], "k int, a string")
    h1 = L.scd2(hist, snap, ["k"], ["a"], F.lit(t1).cast("timestamp_ntz"))
    got = rows(h1, "k", "a", "is_current", "is_deleted")
    assert got == [(1, "x", True, False), (2, "Y", True, False), (2, "y", False, False), (3, "z", False, True),
                   (4, "w", True, False)]
    # key 3 returns
    snap2 = spark.createDataFrame([(1, "x"), (2, "Y"), (3, "z"), (4, "w")], "k int, a string")
    h2 = L.scd2(h1, snap2, ["k"], ["a"], F.lit(T(2024, 1, 3)).cast("timestamp_ntz"))
    cur3 = [r for r in rows(h2, "k", "a", "is_current", "is_deleted") if r[0] == 3]
    assert (3, "z", True, False) in cur3


def test_median_cases(spark):
    df = spark.createDataFrame([("odd", [(1.0, 1), (2.0, 1), (3.0, 1)]), ("even", [(1.0, 1), (2.0, 1), (3.0, 1), (4.0, 1)]),
                                ("one", [(7.0, 1)]), ("empty", []), ("many", [(1.0, 3), (2.0, 2), (9.0, 1)]),
                                ("half", [(1.0, 500), (2.0, 500)])], f"name string, runs {TS.RUNS}")
    got = {r.name: (r.m, r.v) for r in df.select("name", TS.median_of_runs(F.col("runs")).alias("m"),
                                                 TS.values_of_runs(F.col("runs")).alias("v")).collect()}
    assert {k: v[0] for k, v in got.items()} == {"odd": 2.0, "even": 2.5, "one": 7.0, "empty": None, "many": 1.5, "half": 1.5}
    assert got["many"][1] == [1.0, 1.0, 1.0, 2.0, 2.0, 9.0] and got["empty"][1] == []


def test_grid_half_open_chunks(spark):
    states = spark.createDataFrame([("a", T(2024, 1, 1), 1.0), ("a", T(2024, 1, 1, 1, 0, 7), None),
                                    (None, T(2024, 1, 1, 1, 30), 2.0), ("c", T(2024, 1, 1, 3), 3.0)],
                                   "name string, timestamp timestamp_ntz, median double")
    g = TS.unfold(states, F.lit(T(2024, 1, 1, 2, 0, 0)).cast("timestamp_ntz"), "1 second", "1 hour")
    assert g.count() == g.distinct().count() == 7201 + 1801  # N10: no duplicated chunk edges; own starts; c is later
    assert {(r.name, r.median, r.forward_filled): r["count"] for r in g.groupBy("name", "median", "forward_filled").count().collect()} == {
        ("a", 1.0, 0): 2, ("a", 1.0, 1): 7199, (None, 2.0, 0): 1, (None, 2.0, 1): 1800}
    one = TS.unfold(states.limit(1), F.lit(T(2024, 1, 1)).cast("timestamp_ntz"), "1 second", "1 hour")
    assert one.count() == 1


def test_name_cleaning_collision(spark):
    df = spark.createDataFrame([("a b", T(2024, 1, 1), 1.0), ("a-b", T(2024, 1, 1), 5.0)],
                               "name string, timestamp timestamp_ntz, value double")
    long = TS.sensor_long(df, "second", "1 second", "1 hour")
    wide = TS.sensor_wide(long, ["a_b"]).collect()
    assert wide[0]["a_b"] == 5.0  # two names cleaning to one column: max (N12)
    with pytest.raises(Exception, match="unexpected sensor name"):
        TS.sensor_wide(long, ["other"]).collect()


def test_incremental_equals_full(spark):
    base = [("t1", T(2024, 1, 1, 0, 0, s), float(s)) for s in range(0, 20, 3)]
    base += [("t2", T(2024, 1, 1, 0, 0, 5), None)]  # an all-null second
    base += [(None, T(2024, 1, 1, 0, 0, s), float(s % 5)) for s in (1, 1, 4, 4, 4, 9, 15)]  # a NULL name
    added = [("t1", T(2024, 1, 1, 0, 0, 9), 100.0),  # overlap in the middle
             ("t1", T(2024, 1, 1, 0, 0, 30), 1.0),  # new time after the old end
             ("t3", T(2024, 1, 1, 0, 0, 25), 2.0),  # new name
             ("t2", T(2024, 1, 1, 0, 0, 5), 4.0), (None, T(2024, 1, 1, 0, 0, 4), 4.0), (None, T(2024, 1, 1, 0, 0, 9), None)]
    sch = "name string, timestamp timestamp_ntz, value double"
    old_df, add_df = spark.createDataFrame(base, sch), spark.createDataFrame(added, sch)
    prev = TS.sensor_long(old_df, "second", "1 second", "1 hour", keep="runs")
    inc = TS.sensor_incremental(prev, add_df, "second", "1 second", "1 hour")
    full = TS.sensor_long(old_df.unionByName(add_df), "second", "1 second", "1 hour")
    cols = ("name", "timestamp", "forward_filled", "values", "median", "name_cleaned")
    norm = lambda d: sorted(((r[0], r[1], r[2], tuple(r[3]), r[4], r[5]) for r in d.select(*cols).collect()), key=str)
    assert norm(inc) == norm(full)
    counts = TS.sensor_long(old_df.unionByName(add_df), "second", "1 second", "1 hour", keep="count")
    assert sorted(((r.name, r.timestamp, r.forward_filled, r.n_values, r.median) for r in counts.collect()), key=str) == sorted(
        ((r.name, r.timestamp, r.forward_filled, len(r.values), r.median) for r in full.collect()), key=str)


def test_incremental_before_old_start(spark):
    sch = "name string, timestamp timestamp_ntz, value double"
    old_df = spark.createDataFrame([("t1", T(2024, 1, 1, 0, 0, 10), 1.0), ("t1", T(2024, 1, 1, 0, 0, 12), 2.0)], sch)
    add_df = spark.createDataFrame([("t1", T(2024, 1, 1, 0, 0, 5), 3.0)], sch)
    prev = TS.sensor_long(old_df, "second", "1 second", "1 hour", keep="runs")
    inc = TS.sensor_incremental(prev, add_df, "second", "1 second", "1 hour")
    full = TS.sensor_long(old_df.unionByName(add_df), "second", "1 second", "1 hour")
    key = lambda d: sorted((r.name, r.timestamp, r.forward_filled, r.median) for r in d.collect())
    assert key(inc) == key(full)


def test_forward_fill_across_buckets(spark):
    df = spark.createDataFrame([("a", T(2024, 1, 1, 23), 1.0), ("a", T(2024, 1, 2, 1), None),
                                ("a", T(2024, 1, 4, 1), None), ("b", T(2024, 1, 4, 2), None)],
                               "k string, t timestamp_ntz, v double")
    out = FL.forward_fill(df, ["k"], "t", ["v"], "filled")
    assert rows(out, "k", "t", "v", "filled") == [("a", T(2024, 1, 1, 23), 1.0, 0), ("a", T(2024, 1, 2, 1), 1.0, 1),
                                                  ("a", T(2024, 1, 4, 1), 1.0, 1), ("b", T(2024, 1, 4, 2), None, 1)]


def test_asof_cases(spark):
    prices = spark.createDataFrame([("s", T(2024, 1, 2), 10.0), ("s", T(2024, 1, 5), 20.0)],
                                   "k string, d timestamp_ntz, price double")
    targets = spark.createDataFrame([("s", T(2024, 1, 1)), ("s", T(2024, 1, 2)), ("s", T(2024, 1, 4))],
                                    "k string, t timestamp_ntz")
    out = FL.asof_join(targets, prices, ["k"], "t", "d", ["price"])
    assert rows(out, "t", "price") == [(T(2024, 1, 1), None), (T(2024, 1, 2), 10.0), (T(2024, 1, 4), 10.0)]


def test_lead_lag_across_buckets(spark):
    ts = [T(2024, 1, 1, 23, 50), T(2024, 1, 2, 0, 5), T(2024, 1, 2, 0, 7), T(2024, 1, 5, 3, 0)]
    df = spark.createDataFrame([(1, i, t, t) for i, t in enumerate(ts)], "a int, id int, s timestamp_ntz, f timestamp_ntz")
    out = {r.id: r for r in EV.lead_lag(df, ["a"], "s", ["id"], "s", "f").collect()}
    assert out[0].lag1 is None and out[0].lead1 == ts[1]
    assert out[1].lag1 == ts[0] and out[1].lag2 is None
    assert out[2].lag2 == ts[0] and out[2].lead1 == ts[3]
    assert out[3].lag1 == ts[2] and out[3].lag2 == ts[1] and out[3].lead1 is None


def test_graph_components_and_closeness(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "src string, dst string")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("x",), ("y",), ("z",)], "node string")
    cc = dict(rows(G.connected_components(e, nodes), "node", "component"))
    assert cc == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x", "z": "z"}
    d = G.shortest_path_lengths(e, nodes)
    assert d.count() == 9 + 4 + 1
    c = dict(rows(G.closeness(d, 6), "node", "closeness"))
    assert abs(c["a"] - (2 / 5) * (2 / 2)) < 1e-12 and c["z"] == 0.0
    one = G.shortest_path_lengths(e, spark.createDataFrame([("x",)], "node string"))
    assert rows(one, "source", "target", "distance") == [("x", "x", 0), ("x", "y", 1)]


def test_chain_graph_converges(spark):
    n = 40
    e = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}") for i in range(n)], "src string, dst string")
    cc = G.connected_components(e)
    assert cc.select("component").distinct().collect()[0][0] == "n000"


def test_long_path_with_shuffled_ids_is_one_component(spark):
    import random
    n = 2000
    ids = list(range(n))
    random.Random(3).shuffle(ids)
    e = spark.createDataFrame([(ids[i], ids[i + 1]) for i in range(n - 1)] + [(5000, 5001), (5001, 5001), (7000, 7000)],
                              "src long, dst long")
    got = {r.node: r.component for r in G.connected_components(e).collect()}
    assert got == {**dict.fromkeys(range(n), 0), 5000: 5000, 5001: 5000, 7000: 7000}


def test_null_keys_are_one_key(spark):
    day = lambda d: T(2024, 1, d)
    df = spark.createDataFrame([(None, i, day(i), day(i), 1.0 if i == 1 else None) for i in (1, 2, 3)] + [("a", 9, day(2), day(2), 5.0)],
                               "a string, id int, s timestamp_ntz, f timestamp_ntz, v double")
    ll = {r.id: r for r in EV.lead_lag(df, ["a"], "s", ["id"], "s", "f").collect()}
    assert [ll[i].lead1 for i in (1, 2, 3, 9)] == [day(2), day(3), None, None]
    assert [ll[i].lag2 for i in (1, 2, 3)] == [None, None, day(1)]
    n = {r.id: r for r in EV.neighbours(df, ["a"], ["s"], lag_cols=["id"], running_sums=["id"]).collect()}
    assert [(n[i].seq, n[i].cum_id, n[i].lag1_id) for i in (1, 2, 3, 9)] == [(1, 1, None), (2, 3, 1), (3, 6, 2), (1, 9, None)]
    filled = FL.forward_fill(df, ["a"], "s", ["v"], "was_null")
    assert rows(filled.filter("a is null"), "s", "v", "was_null") == [(day(1), 1.0, 0), (day(2), 1.0, 1), (day(3), 1.0, 1)]
    groups = EV.event_rollup(EV.event_groups(df, "a", "s", "f", ["id"]), "a", "s", "f", ["id"])
    assert groups.filter("a is null").count() == 3  # hours apart: a group each
    last = FL.asof_join(df.select("a", "id", "s"), df.filter("v > 0").select("a", "s", "v"), ["a"], "s", "s", ["v"])
    assert {r.id: (r.v, r.asof_s) for r in last.collect()} == {1: (1.0, day(1)), 2: (1.0, day(1)), 3: (1.0, day(1)), 9: (5.0, day(2))}


def test_change_history_of_a_null_key(spark):
    from concord.operators.dedup import change_history
    feed = spark.createDataFrame([(k, "insert", v) for k in (None, 1) for v in (1, 2, 3)],
                                 "k int, _change_type string, _commit_version long")
    got = change_history(feed, ["k"]).filter("k is null")
    assert rows(got, "_commit_version", "prev_version", "change_seq") == [(1, None, 1), (2, 1, 2), (3, 2, 3)]


def test_first_run_detection(spark):
    empty = spark.createDataFrame([], "k int, v string")
    assert L.load_mode(empty) == "full"
    assert L.load_mode(spark.createDataFrame([(1, "a")], "k int, v string")) == "incremental"
    assert L.load_mode(spark.createDataFrame([(1, "a")], "k int, v string"), forced_full=True) == "full"


def test_event_groups_dedup_order(spark):
    t0 = T(2024, 1, 1, 10, 0)
    rows = [(1, "e1", 1, t0, t0), (1, "e1", 2, T(2024, 1, 1, 10, 5), T(2024, 1, 1, 10, 6)),
            (1, "e2", 1, T(2024, 1, 1, 10, 20), T(2024, 1, 1, 10, 21))]
    df = spark.createDataFrame(rows, "a int, ev string, ver int, s timestamp_ntz, f timestamp_ntz")
    first = EV.event_groups(df, "a", "s", "f", ["ev"], dedup_keys=["ev"], dedup_order=[F.col("ver")])
    later = EV.event_groups(df, "a", "s", "f", ["ev"], dedup_keys=["ev"], dedup_order=[F.col("ver")],
                            dedup_first=False)
    assert first.count() == later.count() == 2
    assert {r.ev: r.next_start for r in first.collect()}["e1"] == T(2024, 1, 1, 10, 20)
    assert {r.ev: r.next_start for r in later.collect()}["e1"] == T(2024, 1, 1, 10, 20)


def test_asof_across_empty_buckets(spark):
    prices = spark.createDataFrame([("s", T(2024, 1, 2), 10.0), ("s", T(2024, 1, 9), 20.0), ("u", T(2024, 1, 5), 7.0)],
                                   "k string, d timestamp_ntz, price double")
    targets = spark.createDataFrame([("s", T(2024, 1, 1)), ("s", T(2024, 1, 6)), ("s", T(2024, 1, 9)),
                                     ("s", T(2024, 1, 20)), ("u", T(2024, 1, 4)), ("u", T(2024, 1, 30)),
                                     ("v", T(2024, 1, 3))], "k string, t timestamp_ntz")
    out = FL.asof_join(targets, prices, ["k"], "t", "d", ["price"])
    assert rows(out, "k", "t", "price") == [("s", T(2024, 1, 1), None), ("s", T(2024, 1, 6), 10.0),
                                            ("s", T(2024, 1, 9), 20.0), ("s", T(2024, 1, 20), 20.0),
                                            ("u", T(2024, 1, 4), None), ("u", T(2024, 1, 30), 7.0),
                                            ("v", T(2024, 1, 3), None)]


def test_median_of_many_runs_takes_linear_time(spark):
    """The total of the runs was added up again at every run: 10,000 runs took 100 million steps."""
    import time
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(10_000)), lambda i: F.struct(
        i.cast("double").alias("value"), F.lit(3).cast("bigint").alias("n"))).cast(TS.RUNS).alias("runs"))
    start = time.monotonic()
    assert df.select(TS.median_of_runs(F.col("runs")).alias("m")).first().m == 5000.5
    assert time.monotonic() - start < 10
