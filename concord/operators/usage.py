"""Usage-log summaries and error classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error-text classes, tested in this order (first match wins).
ERROR_CLASSES = (("Invalid object name", "Invalid object name"),
                 ("permission", "Permission Denied"))
OTHER_CLASS = "Others"
UNKNOWN = "Unknown"


def json_field(text: Column, path: str, default: str | None = UNKNOWN) -> Column:
    """a JSON field by path, with a default when missing."""
    v = F.get_json_object(text, path)
    return F.coalesce(v, F.lit(default)) if default is not None else v


def usage_filter(df: DataFrame, id_col: str, name_col: str, dataset_id: Column | str,
                 mode: str = "id") -> DataFrame:
    """V11 filter: ``mode="id"`` keeps activities of the dataset id; ``mode="reference"`` also keeps any
    activity that carries a dataset name (N17)."""
    hit = F.col(id_col) == (F.lit(dataset_id) if isinstance(dataset_id, str) else dataset_id)
    if mode == "reference":
        hit = hit | F.col(name_col).isNotNull()
    return df.where(hit)


def user_summary(df: DataFrame, user_cols: Sequence[str], time_col: str) -> DataFrame:
    """Per user total activities, first and last access (sort by total desc is left to the reader)."""
    return df.groupBy(*user_cols).agg(F.count(F.lit(1)).cast("bigint").alias("total_activities"),
                                      F.min(time_col).alias("first_access"), F.max(time_col).alias("last_access"))


def top_users(summary: DataFrame, n: int) -> DataFrame:
    """T4: the n most active users (a top-k; ties broken by user columns)."""
    others = [c for c in summary.columns if c not in ("total_activities", "first_access", "last_access")]
    return summary.orderBy(F.desc("total_activities"), *others).limit(n)


def load_summary(df: DataFrame, value_col: str, group_col: str, time_col: str) -> DataFrame:
    """Total, mean, number of distinct groups, time range (seconds) over loaded rows."""
    return df.agg(F.sum(value_col).alias("total"), F.avg(value_col).alias("mean"),
                  F.count_distinct(group_col).cast("bigint").alias("n_groups"),
                  (F.unix_micros(F.max(time_col).cast("timestamp")) - F.unix_micros(F.min(time_col).cast("timestamp")))
                  .cast("double").__truediv__(1e6).alias("range_seconds"))


def classify_errors(df: DataFrame, status_col: str, message_col: str, ok_status: str = "accessible") -> DataFrame:
    """Error class per row; accessible rows get NULL (N18) rather than 'Others'."""
    msg = F.col(message_col)
    e = None
    for needle, label in ERROR_CLASSES:
        e = (F.when(msg.contains(needle), label) if e is None else e.when(msg.contains(needle), label))
    e = e.otherwise(OTHER_CLASS)
    return df.withColumn("error_type", F.when(F.col(status_col) == ok_status, F.lit(None)).otherwise(e))


def error_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("error_type").agg(F.count(F.lit(1)).cast("bigint").alias("views"))


def status_counts(report: DataFrame, group_col: str = "environment", status_col: str = "status") -> DataFrame:
    """Ok / error / skipped counts per environment."""
    s = F.col(status_col)
    return report.groupBy(group_col).agg(F.count_if(s == "ok").cast("bigint").alias("ok"),
                                         F.count_if(s == "error").cast("bigint").alias("error"),
                                         F.count_if(s == "skipped").cast("bigint").alias("skipped"))
