"""Streaming tables: upserts, replays and out-of-order change application."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.session import scratch_path
from concord.streaming import jobs as J


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def _upserts(spark, root, checkpoint, land):
    s = J.file_stream(spark, land, SCHEMA, max_files_per_trigger=1)
    J.run_to_completion(J.upsert_batches(s, root, checkpoint=checkpoint, output_mode="append"))


def test_upserted_table_keeps_the_newest_and_survives_a_replayed_epoch(spark):
    import os

    root, land, cp = (scratch_path(spark, x) for x in ("up", "up-land", "up-cp"))
    spark.createDataFrame([(i, "a") for i in range(20)], SCHEMA).coalesce(1).write.parquet(land)
    _upserts(spark, root, cp, land)
    spark.createDataFrame([(0, "b")], SCHEMA).coalesce(1).write.mode("append").parquet(land)
    _upserts(spark, root, cp, land)
    rows = lambda: {r.k: r.v for r in J.read_table(spark, root, ["k"], SCHEMA).collect()}
    assert len(rows()) == 20 and rows()[0] == "b" and rows()[1] == "a"
    # the commit of the last batch is lost, so the engine runs it again
    commits = cp.removeprefix("file:") + "/commits"
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{f}"):
            os.remove(f"{commits}/{f}")
    _upserts(spark, root, cp, land)
    assert len(rows()) == 20 and rows()[0] == "b"
    assert spark.read.parquet(f"{root}/{J.BATCHES}").count() == 21


def test_two_streams_into_one_table_keep_all_rows(spark):
    root, a, b = (scratch_path(spark, x) for x in ("two", "two-a", "two-b"))
    spark.createDataFrame([(i, "a") for i in range(10)], SCHEMA).write.parquet(a)
    spark.createDataFrame([(i, "b") for i in range(8, 13)], SCHEMA).write.parquet(b)
    rows = lambda: {r.k: r.v for r in J.read_table(spark, root, ["k"], SCHEMA).collect()}
    want = {**{i: "a" for i in range(8)}, **{i: "b" for i in range(8, 13)}}
    _upserts(spark, root, None, a)
    _upserts(spark, root, None, b)
    assert rows() == want
    assert J.compact_table(spark, root, ["k"], SCHEMA) == 0
    assert rows() == want
    plan = J.read_table(spark, root, ["k"], SCHEMA)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "epoch" in plan  # folded batches are left out by name
    spark.createDataFrame([(0, "c"), (99, "c")], SCHEMA).write.parquet(a + "-c")
    _upserts(spark, root, None, a + "-c")
    assert rows() == want | {0: "c", 99: "c"}
    assert J.compact_table(spark, root, ["k"], SCHEMA) == 1 and rows() == want | {0: "c", 99: "c"}
    assert J._read_epochs(spark, root, SCHEMA).count() == 14  # one row a key


def test_a_stream_goes_on_after_a_fold(spark):
    root, land, cp = (scratch_path(spark, x) for x in ("on", "on-land", "on-cp"))
    spark.createDataFrame([(1, "a"), (2, "a")], SCHEMA).write.parquet(land)
    _upserts(spark, root, cp, land)
    J.compact_table(spark, root, ["k"], SCHEMA)
    spark.createDataFrame([(2, "b"), (3, "b")], SCHEMA).write.mode("append").parquet(land)
    _upserts(spark, root, cp, land)
    assert {r.k: r.v for r in J.read_table(spark, root, ["k"], SCHEMA).collect()} == {1: "a", 2: "b", 3: "b"}


def test_a_repeated_file_changes_nothing(spark):
    import datetime as dt

    sch = "id long, ts timestamp_ntz, v string"
    events = spark.createDataFrame([(i, dt.datetime(2024, 1, 1, i % 24), "x") for i in range(30)], sch).coalesce(1)
    land, target, cp = (scratch_path(spark, x) for x in ("rep", "rep-out", "rep-cp"))
    for n in (1, 2):
        events.write.mode("append").parquet(land)  # the second file brings the same events
        s = J.distinct_events(J.file_stream(spark, land, events.schema, max_files_per_trigger=1), ["id"], "ts", "7 days")
        J.run_to_completion(J.append_to_table(s, target, checkpoint=cp))
        assert spark.read.parquet(target).count() == 30


def test_a_folded_change_table_keeps_its_tombstones(spark):
    fs = "k long, v string, _change_type string, _commit_version long"
    root, land = scratch_path(spark, "tomb"), scratch_path(spark, "tomb-land")
    spark.createDataFrame([(1, "a", "delete", 5), (2, "b", "insert", 5)], fs).write.parquet(land)
    apply = lambda path: J.run_to_completion(J.apply_change_feed(spark.readStream.schema(fs).parquet(path), root, SCHEMA))
    apply(land)
    J.compact_change_table(spark, root, ["k"], SCHEMA)
    late = scratch_path(spark, "tomb-late")
    spark.createDataFrame([(1, "old", "insert", 4), (2, "old", "insert", 4)], fs).write.parquet(late)
    apply(late)
    assert sorted(tuple(r) for r in J.read_change_table(spark, root, ["k"], SCHEMA).collect()) == [(2, "b")]


def test_a_failing_read_raises(spark):
    import pytest

    root = scratch_path(spark, "broken")
    spark.createDataFrame([(1, "a")], SCHEMA).write.parquet(f"{root}/{J.BATCHES}/run=r/epoch=0")
    path = root.removeprefix("file:")
    import glob
    for f in glob.glob(f"{path}/{J.BATCHES}/run=r/epoch=0/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"no parquet")
    for f in glob.glob(f"{path}/{J.BATCHES}/run=r/epoch=0/.*.crc"):
        import os
        os.remove(f)
    with pytest.raises(Exception):
        J.read_table(spark, root, ["k"], SCHEMA).collect()


def test_change_table_is_order_independent(spark):
    schema = SCHEMA
    fs = "k long, v string, _change_type string, _commit_version long"
    v1 = spark.createDataFrame([(1, "a", "insert", 1), (2, "b", "insert", 1)], fs)
    v2 = spark.createDataFrame([(1, "a", "delete", 2), (1, "a2", "insert", 2), (2, "b", "delete", 2)], fs)
    root = scratch_path(spark, "ct")
    land = scratch_path(spark, "ct-land")
    v2.write.parquet(land + "/v2")  # newer version lands first
    v1.write.parquet(land + "/v1")
    stream = spark.readStream.schema(fs).option("maxFilesPerTrigger", 1).parquet(land + "/*")
    J.run_to_completion(J.apply_change_feed(stream, root, schema))
    assert sorted(tuple(r) for r in J.read_change_table(spark, root, ["k"], schema).collect()) == [(1, "a2")]


def test_outputs_and_run_log(spark):
    import datetime as dt

    from concord.sources import sinks as SK
    root = scratch_path(spark, "outs")
    a = spark.createDataFrame([(1,)], "x int")
    paths = SK.write_outputs({"long": a, "map": a}, root, mode="overwrite")
    SK.write_outputs({"long": a}, root, mode="append")
    assert spark.read.parquet(paths["long"]).count() == 2 and spark.read.parquet(paths["map"]).count() == 1
    runs = spark.createDataFrame([(1, "r1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1), "Succeeded", None, 5),
                                  (1, "r2", dt.datetime(2024, 1, 2), None, "Started", None, None)],
                                 "flow int, run_id string, started_at timestamp_ntz, finished_at timestamp_ntz, "
                                 "status string, message string, row_count int")
    log = SK.run_log_entries(runs)
    assert log.count() == 3
    cur = {r.run_id: r.status for r in SK.run_log_current(log).collect()}
    assert cur == {"r1": "Succeeded", "r2": "Started"}


def test_watermark_drops_late_rows(spark):
    import datetime as dt

    sch = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("k", T.StringType())])
    land = scratch_path(spark, "late-land")
    # three files, one per micro-batch; the late-event watermark is the previous batch's watermark, so the
    # 1 January row in the third batch is behind it (10 Jan - 1 day)
    spark.createDataFrame([(dt.datetime(2024, 1, 10, 5), "a")], sch).coalesce(1).write.parquet(land)
    spark.createDataFrame([(dt.datetime(2024, 1, 10, 6), "a")], sch).coalesce(1).write.mode("append").parquet(land)
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "a")], sch).coalesce(1).write.mode("append").parquet(land)
    agg = J.windowed_counts(J.file_stream(spark, land, sch, max_files_per_trigger=1), "ts", "1 day", "1 day", ["k"])
    root = scratch_path(spark, "late-out")
    J.run_to_completion(J.upsert_batches(agg, root))
    got = {(r.window_start.day, r.events) for r in J.read_table(spark, root, ["window_start", "k"], agg.schema).collect()}
    assert got == {(10, 2)}


def test_html_table_rows(spark):
    from concord.sources import html as RD
    html = ("<table><thead><tr><th>Date</th><th>Close</th></tr></thead><tbody>"
            "<tr><td> 2024-01-02 </td><td><b>10.5</b></td></tr>\n<tr><td>2024-01-03</td><td>11</td></tr></tbody></table>")
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r.position, list(r.cells)) for r in RD.html_table_rows(pages, "page_id", "html").orderBy("position").collect()]
    assert got == [(0, ["2024-01-02", "10.5"]), (1, ["2024-01-03", "11"])]
    items = spark.createDataFrame([(1, "<link href='x'><ul><li>a &amp;\n <b>b</b></li><li class=z>&amp;lt;</li></ul>")],
                                  "page_id long, html string")
    assert [r.text for r in RD.html_items(items, "page_id", "html").orderBy("position").collect()] == ["a & b", "&lt;"]


def test_complete_mode_equals_batch(spark):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    land = scratch_path(spark, "complete-land")
    src.repartition(4).write.parquet(land)
    s = J.file_stream(spark, land, src.schema, max_files_per_trigger=2)
    agg = s.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    seen = {}

    def keep(df, epoch):
        seen["last"] = sorted((r.event_type, r.events) for r in df.collect())  # complete mode: a few rows
    J.run_to_completion(J.foreach_batch(agg, keep, output_mode="complete"))
    expect = sorted((r.event_type, r["count"]) for r in src.groupBy("event_type").count().collect())
    assert seen["last"] == expect


def test_parse_iso_utc(spark):
    import datetime as dt

    from concord.sources import readers as RD
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02T03:04:05.123Z",), ("2024-01-02T03:04:05",),
                                ("not a date",), (None,)], "s string")
    got = [r.t for r in df.select(RD.parse_iso_utc(F.col("s")).alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 123000),
                   dt.datetime(2024, 1, 2, 3, 4, 5), None, None]
