"""Column-catalogue scans (S2) and nested metadata flattening.

The catalogue of a DataFrame is metadata (one row per column), built from the
schema on the driver; no table data is read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as TY

CATALOGUE_SCHEMA = ("table_name string, column_name string, data_type string, numeric_precision int, "
                    "numeric_scale int, ordinal_position int")


def column_catalogue(spark: SparkSession, tables: Mapping[str, DataFrame],
                     exclude_prefixes: Iterable[str] = (), upper: bool = False) -> DataFrame:
    """(table_name, column_name, data_type, numeric_precision, numeric_scale, ordinal_position).

    ``data_type`` is the right-system name (e.g. BIGINT, STRING,
    TIMESTAMP_NTZ, DECIMAL(18,2)); names starting with an excluded prefix are
    skipped; ``upper`` upper-cases the names.
    """
    rows = []
    pre = [p.lower() for p in exclude_prefixes]
    for t, df in tables.items():
        for i, f in enumerate(df.schema.fields):
            if any(f.name.lower().startswith(p) for p in pre):
                continue
            dt = f.dataType
            prec = dt.precision if isinstance(dt, T.DecimalType) else None
            scale = dt.scale if isinstance(dt, T.DecimalType) else None
            rows.append((t, f.name.upper() if upper else f.name, TY.spark_type_name(dt), prec, scale, i + 1))
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


def as_left_catalogue(cat: DataFrame) -> DataFrame:
    """Express a right-side catalogue in the left system's type names (first accepted type, lower case;
    types without a left equivalent become ``sql_variant``)."""
    kv = []
    for k, v in TY.RIGHT_TO_LEFT_TYPES.items():
        kv += [F.lit(k), F.lit(v[0].lower())]
    m = F.create_map(*kv)
    return cat.withColumn("data_type", F.coalesce(m[TY.base_type_col(F.col("data_type"))], F.lit("sql_variant")))


def entity_metadata(raw: DataFrame) -> DataFrame:
    """Nested entity metadata -> (logical_name, display_name, entity_set_name, is_custom), rows without
    a set name dropped, sorted by logical name.  The optional nested label is NULL when absent."""
    label = F.col("DisplayName.UserLocalizedLabel.Label") if "DisplayName" in raw.columns else F.lit(None)
    return (raw.where(F.col("EntitySetName").isNotNull())
            .select(F.col("LogicalName").alias("logical_name"), label.cast("string").alias("display_name"),
                    F.col("EntitySetName").alias("entity_set_name"),
                    F.col("IsCustomEntity").cast("boolean").alias("is_custom"))
            .orderBy("logical_name"))


def filter_catalogue(cat: DataFrame, prefixes: Iterable[str] = (), suffixes: Iterable[str] = ()) -> DataFrame:
    """P1 on a catalogue: drop rows whose (upper-cased) name starts/ends with a technical marker."""
    name = F.upper(F.col("column_name"))
    keep = F.lit(True)
    for p in prefixes:
        keep = keep & ~name.startswith(p.upper())
    for s in suffixes:
        keep = keep & ~name.endswith(s.upper())
    return cat.where(keep)
