"""Typed table migration and sync configuration.

The sync configuration is an aggregate over the column catalogue (one group per
table).  Migration writes each mapped table with ``df.write`` in parallel; the
driver only loops over table names and collects one metrics row per table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as TY
from ..functions.normalize import null_non_finite
from ..sources.catalog import as_left_catalogue, column_catalogue

# Attribute types renamed "_<name>_value" on the source side.
LOOKUP_TYPES = ("Lookup", "Customer", "Owner")


def mapped_type(cat: DataFrame) -> Column:
    """Right DDL type of each left catalogue row (unknown -> STRING; decimal default (38,0))."""
    return TY.left_to_right_ddl_col(F.col("data_type"), F.col("numeric_precision"), F.col("numeric_scale"))


def source_column_name(name: Column, attr_type: Column | None) -> Column:
    """Lookup-type attributes are read as ``_<name>_value`` on the source side."""
    if attr_type is None:
        return name
    return F.when(attr_type.isin(*LOOKUP_TYPES), F.concat(F.lit("_"), name, F.lit("_value"))).otherwise(name)


def sync_config(left_cat: DataFrame, target_prefix: str, attr_type_col: str | None = None) -> DataFrame:
    """One row per table from the (left) column catalogue.

    sync_table_name = table + 's'; target_table = prefix.table; column_list =
    lower-case names sorted and joined; primary_key_column = '<table>id' if
    present, else the first (sorted) name ending in 'id', else the first name
    (F26); phantom_row_sql = ``SELECT CAST(NULL AS <type>) AS <c>, ... WHERE 1=0``
    in column_list order (S9); column_mapping = JSON map source name -> column.
    """
    c = left_cat.select("table_name", F.lower("column_name").alias("col"), mapped_type(left_cat).alias("ddl"),
                        source_column_name(F.lower("column_name"),
                                           F.col(attr_type_col) if attr_type_col else None).alias("src"))
    prio = (F.when(F.col("col") == F.concat(F.col("table_name"), F.lit("id")), 0)
            .when(F.col("col").endswith("id"), 1).otherwise(2))
    g = c.groupBy("table_name").agg(
        F.array_sort(F.collect_list(F.struct("col", "ddl", "src"))).alias("cols"),
        F.min_by("col", F.struct(prio, F.col("col"))).alias("primary_key_column"))
    phantom = F.concat(F.lit("SELECT "), F.array_join(F.transform(
        "cols", lambda x: F.concat(F.lit("CAST(NULL AS "), x["ddl"], F.lit(") AS "), x["col"])), ", "),
        F.lit(" WHERE 1=0"))
    mapping = F.to_json(F.map_from_arrays(F.transform("cols", lambda x: x["src"]),
                                          F.transform("cols", lambda x: x["col"])))
    return g.select(F.concat("table_name", F.lit("s")).alias("sync_table_name"),
                    F.lit("").alias("last_sync_timestamp"),
                    F.concat(F.lit(target_prefix + "."), F.col("table_name")).alias("target_table"),
                    F.array_join(F.transform("cols", lambda x: x["col"]), ", ").alias("column_list"),
                    "primary_key_column", phantom.alias("phantom_row_sql"), mapping.alias("column_mapping"))


def empty_typed(spark: SparkSession, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """An empty relation with the given (name, DDL type) columns."""
    schema = ", ".join(f"`{n}` {t}" for n, t in columns)
    return spark.createDataFrame([], schema)


def cast_to_mapped(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Cast columns to their mapped DDL types (S8); ``types`` maps column -> DDL text."""
    t = dict(types or {})
    return df.select(*[F.col(f"`{c}`").cast(t[c]).alias(c) if c in t else F.col(f"`{c}`") for c in df.columns])


def mapped_types(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, dict[str, str]]:
    """Per table the DDL type of each column, from the tables' catalogue in the left system's types (metadata only).
    A type the left system does not have keeps its own."""
    cat = column_catalogue(spark, {n: d for n, d in tables.items() if d.columns})
    left = as_left_catalogue(cat)
    out: dict[str, dict[str, str]] = {}
    for r in left.select("table_name", "column_name", mapped_type(left).alias("ddl")).collect():
        out.setdefault(r["table_name"], {})[r["column_name"]] = r["ddl"]
    return out


def _verified(spark: SparkSession, path: str) -> tuple[int, int, float | None]:
    """Rows, NULLs in numeric columns and the sum of all numeric values of a written table."""
    back = spark.read.parquet(path)
    numbers = [F.col(f"`{f.name}`") for f in back.schema.fields if isinstance(f.dataType, T.NumericType)]
    zero = F.lit(0)
    total = F.round(F.sum(sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in numbers), zero)), 2)
    r = back.agg(F.count(F.lit(1)), F.sum(sum((c.isNull().cast("long") for c in numbers), zero)), total).first()
    return r[0], r[1] or 0, r[2]


REPORT = ("environment string, table_name string, status string, rows bigint, rows_read_back bigint, null_values bigint, "
          "checksum double, types string, error string")


def migrate_tables(spark: SparkSession, tables: Mapping[str, DataFrame], target_root: str,
                   environments: Sequence[str] = ("dev",), types: Mapping[str, Mapping[str, str]] | None = None,
                   mode: str = "overwrite", at_once: int = 4) -> DataFrame:
    """M16 + S7 + S8: per environment and table create-or-replace from the mapped schema, copy, and read back.

    Column types come from the left catalogue (``types`` overrides single columns); non-finite floats become NULL on the
    way (F25).  One row per (environment, table): status ok / skipped (no columns) / error, rows written (counted during
    the write), rows, numeric NULLs and the sum of all numbers as read back, and the whole error text.  The copies are
    independent Spark jobs, ``at_once`` of them at a time.
    """
    ddl = mapped_types(spark, tables)

    def copy(job: tuple[str, str]) -> tuple:
        env, name = job
        df = tables[name]
        if not df.columns:
            return (env, name, "skipped", 0, 0, None, None, None, None)
        t = {**ddl.get(name, {}), **(types or {}).get(name, {})}
        shown = ", ".join(f"{c} {t[c]}" for c in df.columns if c in t)
        path = f"{target_root.rstrip('/')}/{env}/{name}"
        try:
            obs = Observation(f"rows_{env}_{name}")
            out = null_non_finite(cast_to_mapped(df, t))
            out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
            return (env, name, "ok", int(obs.get["rows"]), *_verified(spark, path), shown, None)
        except PySparkException as e:  # one failing table does not stop the batch
            return (env, name, "error", 0, 0, None, None, shown, str(e))

    with ThreadPoolExecutor(at_once) as pool:
        report = list(pool.map(copy, [(env, name) for env in environments for name in tables]))
    return spark.createDataFrame(report, REPORT)
