"""Readers: projected scans, capped and sampled reads, JSON envelopes, CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, fmt: str = "parquet", columns: Sequence[str] | None = None,
         where: Column | str | None = None, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Read a table with a projection and a filter; Catalyst pushes both into the scan
    (``PushedFilters`` / ``ReadSchema`` in the plan).  Formats: parquet, json, csv, orc, text, or a
    table name with ``fmt="table"``."""
    if fmt == "table":
        df = spark.table(path)
    else:
        r = spark.read.format(fmt).options(**options)
        if schema is not None:
            r = r.schema(schema)
        df = r.load(path)
    if columns:
        df = df.select(*columns)
    if where is not None:
        df = df.where(where)
    return df


def capped(df: DataFrame, n: int, order: Sequence[Column | str] | None = None) -> DataFrame:
    """S3: first n rows (``TOP n``); with ``order`` the result is stable (top-k, no global sort)."""
    return (df.orderBy(*order) if order else df).limit(n)


def random_sample(df: DataFrame, keys: Sequence[str] = (), n: int | None = None, fraction: float | None = None,
                  seed: int = 42) -> DataFrame:
    """The ``n`` rows that come first by the MD5 of seed and ``keys`` (distributed top-k; any engine can repeat
    it), or a Bernoulli ``fraction`` for large samples."""
    if fraction is not None:
        return df.sample(fraction=fraction, seed=seed)
    named = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys or df.columns]
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *named).cast("binary")), *keys).limit(int(n))


def json_envelope(spark: SparkSession, path: str, record_schema: T.StructType, field: str = "data",
                  multi_line: bool = False) -> DataFrame:
    """JSON documents ``{"<field>": [record, ...]}`` -> one row per record with the given schema."""
    schema = T.StructType([T.StructField(field, T.ArrayType(record_schema))])
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return df.select(F.explode(F.col(field)).alias("r")).select("r.*")


ISO_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?Z?$"


def parse_iso_utc(c: Column) -> Column:
    """ISO-8601 UTC text (``2024-01-02T03:04:05Z``, optionally with 1-6 fraction digits) ->
    timestamp_ntz (UTC wall clock); text of another shape gives NULL instead of an ANSI error."""
    parsed = F.to_timestamp_ntz(F.regexp_replace(c, r"Z$", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))
    return F.when(c.rlike(ISO_UTC), parsed)


#: NULL in a CSV file (other values that begin with a backslash get one more), and the format's options.
CSV_NULL = "\\N"
CSV_FORMAT = {"nullValue": CSV_NULL, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """Files of :func:`.sinks.write_csv` with an explicit schema (no inference pass), value for value.

    Values may hold quotes and line ends, so a file is read by one task; the writer makes a file per partition."""
    df = spark.read.schema(schema).options(**CSV_FORMAT).option("emptyValue", "").option("multiLine", True).option("header", header).csv(path)
    plain = lambda c: F.when(c.startswith("\\\\"), F.substring(c, 2, (1 << 31) - 1)).otherwise(c)
    return df.select(*[plain(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict, columns: Sequence[str] | None = None,
               where: str | None = None, partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """S1 against a remote database: the projection and the filter are sent inside the query (pushed down),
    and a numeric ``partition_column`` with bounds splits the read into ``num_partitions`` parallel range
    queries (one connection per task, never one client pulling the whole table)."""
    cols = ", ".join(columns) if columns else "*"
    query = f"(SELECT {cols} FROM {table}" + (f" WHERE {where}" if where else "") + ") AS q"
    r = spark.read.format("jdbc").option("url", url).option("dbtable", query)
    for k, v in properties.items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def jdbc_catalogue(spark: SparkSession, url: str, properties: dict, schema: str,
                   tables: Sequence[str] | None = None) -> DataFrame:
    """S2 against a remote database: one metadata query over ``information_schema.columns`` for all tables
    (names upper-cased), in the column-catalogue shape used by :mod:`concord.sources.catalog`."""
    where = f"table_schema = '{schema}'"
    if tables:
        where += " AND table_name IN (" + ", ".join(f"'{t}'" for t in tables) + ")"
    cols = ["table_name", "upper(column_name) AS column_name", "data_type", "numeric_precision", "numeric_scale",
            "ordinal_position"]
    return jdbc_table(spark, url, "information_schema.columns", properties, cols, where)
