"""Registered source / sink and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources import html as HT
from ..sources import readers as RD
from ..sources import sinks as SK
from ..streaming import jobs as J
from . import data as D
from . import sqlparts as S
from .registry import query

RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("type_id", T.StringType()),
                       T.StructField("date", T.StringType()), T.StructField("price", T.StringType())])


@query("json_price_records", ("S5", "F17", "F10", "S21"),
       sql="""SELECT o_orderkey AS id, o_orderpriority AS type_id, o_orderdate AS date, o_totalprice AS price FROM orders""")
def json_price_records(spark, sf):
    """Orders landed as JSON envelopes (``{"data": [...]}`` lines of at most 1000 records) and read back typed."""
    o = D.load(spark, sf, "orders")
    rec = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("type_id"),
                   F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
                   F.col("o_totalprice").cast("string").alias("price"))
    path = scratch_path(spark, "json-envelopes")
    # envelopes of at most 1000 consecutive records of one input partition: a bounded group per line
    env = F.floor(F.monotonically_increasing_id() / 1000)
    (o.select(env.alias("env"), rec.alias("r")).groupBy("env").agg(F.collect_list("r").alias("data"))
     .select("data").write.mode("overwrite").json(path))
    r = RD.json_envelope(spark, path, RECORD)
    return r.select("id", "type_id", RD.parse_iso_utc(F.col("date")).alias("date"),
                    F.col("price").cast("double").alias("price"))


# the items by cutting the page at its tags, not by the operator's own pattern
_LI_SQL = """WITH c AS (SELECT page_id, unnest(string_split(html, '<li')[2:]) AS piece,
                           generate_subscripts(string_split(html, '<li')[2:], 1) AS n FROM pages),
                  i AS (SELECT page_id, n, split_part(substr(piece, instr(piece, '>') + 1), '</li>', 1) AS item
                        FROM c WHERE (piece[1] = '>' OR piece[1] = ' ') AND instr(piece, '</li>') > 0),
                  t AS (SELECT page_id, n, regexp_replace(item, '<[^>]+>', '', 'g') AS t FROM i)
             SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS position,
                    trim(regexp_replace(replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
                         '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '\\s+', ' ', 'g')) AS text FROM t"""


@query("html_list_items", ("S20",), sql=_LI_SQL)
def html_list_items(spark, sf):
    return HT.html_items(D.load(spark, sf, "pages"), "page_id", "html")


@query("html_links", ("S20",),
       sql="""SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS BIGINT) AS position, unnest(h) AS href
              FROM (SELECT page_id, regexp_extract_all(html, '<a\\s+href="([^"]*)"', 1) AS h FROM pages)""")
def html_links(spark, sf):
    return HT.html_links(D.load(spark, sf, "pages"), "page_id", "html")


@query("html_table_rows", ("S20",),
       sql="""SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS position,
                     CAST(o_orderkey AS VARCHAR) AS c1, o_orderpriority || ' & <' || o_orderstatus || '>' AS c2 FROM orders""")
def html_table_rows(spark, sf):
    """Each customer's orders as an HTML table (head, body, character references, cells over several lines), read back."""
    o = D.load(spark, sf, "orders")
    row = F.concat(F.lit("<tr class='o'>\n<td> "), F.col("o_orderkey").cast("string"), F.lit("</td><td><b>"),
                   F.col("o_orderpriority"), F.lit("</b>\n &amp; &lt;"), F.col("o_orderstatus"), F.lit("&gt;</td></tr>"))
    rows = F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("tr"))))
    page = F.concat(F.lit("<table><thead><tr><th>Key</th><td>not a row</td></tr></thead><tbody>"),
                    F.array_join(F.transform(rows, lambda x: x["tr"]), "\n"), F.lit("</tbody></table>"))
    pages = o.groupBy("o_custkey").agg(page.alias("html"))
    r = HT.html_table_rows(pages, "o_custkey", "html")
    return r.select("o_custkey", "position", F.get("cells", 0).alias("c1"), F.get("cells", 1).alias("c2"))


@query("csv_roundtrip", ("S6", "S21", "S1"),
       sql="""SELECT c_custkey, c_acctbal, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN c_name || chr(13) || chr(10) || '"x",'
                WHEN 3 THEN '  ' || c_name || ' ' WHEN 4 THEN '\\N' ELSE c_mktsegment END AS note FROM customer WHERE c_acctbal > 0""")
def csv_roundtrip(spark, sf):
    """Customers with notes that are NULL, empty, quoted, of two lines, blank-padded or look like the mark of NULL."""
    path = scratch_path(spark, "csv")
    k = F.col("c_custkey") % 6
    note = (F.when(k == 0, F.lit(None)).when(k == 1, "").when(k == 2, F.concat("c_name", F.lit('\r\n"x",')))
            .when(k == 3, F.concat(F.lit("  "), "c_name", F.lit(" "))).when(k == 4, "\\N").otherwise(F.col("c_mktsegment")))
    SK.write_csv(D.load(spark, sf, "customer").select("c_custkey", "c_acctbal", note.alias("note")), path)
    return RD.read_csv(spark, path, "c_custkey bigint, c_acctbal double, note string").where(F.col("c_acctbal") > 0)


@query("partitioned_fact", ("S16",),
       sql="""SELECT strftime(l_shipdate, '%Y-%m') AS event_month, CAST(count(*) AS BIGINT) AS lines, round(sum(l_extendedprice), 2) AS revenue
              FROM lineitem GROUP BY 1""")
def partitioned_fact(spark, sf):
    """The fact written by month and read back, all months."""
    path = scratch_path(spark, "fact")
    SK.write_partitioned_fact(D.load(spark, sf, "lineitem"), path, "l_shipdate")
    f = spark.read.parquet(path)
    return f.groupBy(F.col("event_month").cast("string").alias("event_month")).agg(
        F.count(F.lit(1)).cast("bigint").alias("lines"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))


@query("written_outputs", ("S11",),
       sql="""WITH long AS (SELECT c_custkey AS id, c_mktsegment AS name, c_acctbal AS value FROM customer),
                   late AS (SELECT s_suppkey AS id, 'SUPPLIER' AS name, s_acctbal AS value FROM supplier)
              SELECT output, CAST(count(*) AS BIGINT) AS rows, round(sum(value), 2) AS value_sum FROM (
                SELECT 'long' AS output, value FROM (SELECT * FROM long UNION ALL SELECT * FROM late)
                UNION ALL SELECT 'totals', sum(value) FROM late GROUP BY name
                UNION ALL SELECT 'names', CAST(count(*) AS DOUBLE) FROM long GROUP BY name
                UNION ALL SELECT 'names', CAST(count(*) AS DOUBLE) FROM late GROUP BY name) GROUP BY output""")
def written_outputs(spark, sf):
    """Three outputs of one run (rows, totals, names), first replaced, then extended (rows, names) or replaced (totals),
    and read back."""
    root = scratch_path(spark, "outputs")

    def outputs(rows):
        per = rows.groupBy("name")
        return {"long": rows, "totals": per.agg(F.sum("value").alias("value")),
                "names": per.agg(F.count(F.lit(1)).cast("double").alias("value"))}

    c = D.load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS name", "c_acctbal AS value")
    late = D.load(spark, sf, "supplier").selectExpr("s_suppkey AS id", "'SUPPLIER' AS name", "s_acctbal AS value")
    SK.write_outputs(outputs(c), root, mode="overwrite")
    more = outputs(late)
    SK.write_outputs({"totals": more.pop("totals")}, root, mode="overwrite")
    paths = SK.write_outputs(more, root, mode="append")
    paths["totals"] = f"{root}/totals"
    out = None
    for name, path in paths.items():
        one = spark.read.parquet(path).select(F.lit(name).alias("output"), "value")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("output").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                     F.round(F.sum("value"), 2).alias("value_sum"))


_RUNS_SQL = """SELECT user_id AS flow, CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, min(ts) AS started_at, max(ts) AS finished_at,
                      CASE WHEN count_if(event_type = 'error') > 2 THEN 'Failed' ELSE 'Succeeded' END AS status,
                      CAST(count(*) AS BIGINT) AS row_count FROM events GROUP BY 1, 2"""


def _runs(spark, sf):
    ev = D.load(spark, sf, "events")
    return (ev.groupBy(F.col("user_id").alias("flow"), F.to_date("ts").cast("string").alias("run_id"))
            .agg(F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
                 F.when(F.count_if(F.col("event_type") == "error") > 2, "Failed").otherwise("Succeeded").alias("status"),
                 F.count(F.lit(1)).cast("bigint").alias("row_count"))
            .withColumn("message", F.lit(None).cast("string")))


@query("run_log", ("S22", "W2"),
       sql=f"""SELECT flow, run_id, status, started_at, finished_at, CAST(NULL AS VARCHAR) AS message, row_count, finished_at AS logged_at
               FROM ({_RUNS_SQL})""")
def run_log(spark, sf):
    log = SK.run_log_entries(_runs(spark, sf))
    return SK.run_log_current(log)


@query("capped_scan", ("S3", "S1", "T1"),
       sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 1000")
def capped_scan(spark, sf):
    df = RD.scan(spark, f"{sf}/orders.parquet", columns=["o_orderkey", "o_totalprice", "o_orderstatus"],
                 where=F.col("o_orderstatus") == "F")
    return RD.capped(df.select("o_orderkey", "o_totalprice"), 1000, ["o_orderkey"])


@query("random_sample", ("S4",),
       sql="""SELECT o_orderkey, o_totalprice FROM orders
              ORDER BY md5('7|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 500""")
def random_sample(spark, sf):
    """Sampling is the feature: 500 orders in the order of a seeded hash of their key."""
    return RD.random_sample(D.load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], n=500, seed=7)


# ------------------------------------------------------------------ streaming

EVENTS_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                              T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                              T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def _land_events(spark, sf, again=False):
    """The events table landed by two loads in a landing folder (the stream's source files follow the input's); with
    ``again`` a third load brings every third event once more."""
    path = scratch_path(spark, "landing-events")
    ev = D.load(spark, sf, "events")
    if again:
        ev.where(F.pmod("event_id", F.lit(3)) == 0).write.parquet(path)
    for part in (0, 1):  # two loads, so that there is more than one file whatever the input's own files
        ev.where(F.pmod("event_id", F.lit(2)) == part).write.mode("append").parquet(path)
    return path


@query("stream_ingest", ("R1", "R2", "R3", "S17", "S15"),
       sql="SELECT event_type, CAST(count(*) AS BIGINT) AS events, round(sum(value), 4) AS value_sum FROM events GROUP BY 1")
def stream_ingest(spark, sf):
    """Landed events, some of them twice, each copied once."""
    src = _land_events(spark, sf, again=True)
    target = scratch_path(spark, "bronze-events")
    events = J.distinct_events(J.file_stream(spark, src, EVENTS_SCHEMA, max_files_per_trigger=1), ["event_id"], "ts", "31 days")
    J.run_to_completion(J.append_to_table(events, target))
    t = spark.read.parquet(target)
    return t.groupBy("event_type").agg(F.count(F.lit(1)).cast("bigint").alias("events"),
                                       F.round(F.sum("value"), 4).alias("value_sum"))


@query("stream_window_counts", ("R4", "R3", "R5"),
       sql="""SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
                     event_type, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY ALL""")
def stream_window_counts(spark, sf):
    src = _land_events(spark, sf)
    root = scratch_path(spark, "gold-window-counts")
    agg = J.windowed_counts(J.file_stream(spark, src, EVENTS_SCHEMA, max_files_per_trigger=1), "ts", "1 day",
                            "31 days", ["event_type"])
    J.run_to_completion(J.upsert_batches(agg, root))
    J.compact_table(spark, root, ["window_start", "event_type"], agg.schema)
    return J.read_table(spark, root, ["window_start", "event_type"], agg.schema)


FEED_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                            T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
                            T.StructField("o_orderdate", T.TimestampNTZType()),
                            T.StructField("o_orderpriority", T.StringType()),
                            T.StructField("_change_type", T.StringType()),
                            T.StructField("_commit_version", T.LongType()),
                            T.StructField("_commit_timestamp", T.TimestampNTZType())])


@query("stream_cdc_merge", ("R5", "R7", "R6", "M4", "S13"),
       sql=f"""WITH f AS ({S.ORDERS_FEED}),
                    l AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _commit_version DESC,
                           CASE WHEN _change_type = 'delete' THEN 0 ELSE 1 END DESC) AS rn FROM f) WHERE rn = 1)
               SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM l WHERE _change_type <> 'delete'""")
def stream_cdc_merge(spark, sf):
    """The change feed is landed one folder per commit version and streamed a few files per trigger, in
    whatever order the files are listed; readers take the newest version per key, so the result
    equals the feed's final state."""
    o = D.load(spark, sf, "orders")
    feed = D.orders_change_feed(o)
    land = scratch_path(spark, "landing-feed")
    feed.write.partitionBy("_commit_version").parquet(land)  # a version = a folder of files
    root = scratch_path(spark, "silver-orders")
    for odd in (0, 1):  # two streams into one table, folded in between
        stream = spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", 4).parquet(land)
        J.run_to_completion(J.apply_change_feed(stream.where(F.pmod("o_orderkey", F.lit(2)) == odd), root, o.schema))
        J.compact_change_table(spark, root, ["o_orderkey"], o.schema)
    return J.read_change_table(spark, root, ["o_orderkey"], o.schema)


@query("stream_bookmark", ("R7", "S15"),
       sql=f"""SELECT 'orders_feed' AS source, 'orders_history' AS target, max(_commit_version) AS last_version,
                      CAST(count(*) AS BIGINT) AS changes, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS keys
               FROM ({S.ORDERS_FEED}) WHERE _change_type IN ('insert', 'update_postimage', 'delete')""")
def stream_bookmark(spark, sf):
    """The change feed copied into a history table by a stream; the bookmark is what has arrived there."""
    o = D.load(spark, sf, "orders")
    land, root = scratch_path(spark, "landing-history"), scratch_path(spark, "orders-history")
    D.orders_change_feed(o).write.parquet(land)
    J.run_to_completion(J.apply_change_feed(J.file_stream(spark, land, FEED_SCHEMA, max_files_per_trigger=2), root, o.schema))
    history = J.change_rows(spark, root, o.schema)
    counts = history.agg(F.count(F.lit(1)).alias("changes"), F.count_distinct("o_orderkey").alias("keys"),
                         F.max("_commit_version").alias("last_version"))
    mark = J.applied_bookmark(spark, root, o.schema, "orders_feed", "orders_history")
    return mark.join(counts, "last_version").select("source", "target", "last_version", "changes", "keys")
