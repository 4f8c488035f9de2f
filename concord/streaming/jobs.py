"""Structured Streaming forms of the ingest and change-capture jobs.

Every job reads a file source with an explicit schema, keeps its progress in a
checkpoint folder (below ``spark.checkpoint.dir`` unless given), and can run
once over everything available (``trigger(availableNow=True)``), so the same
code serves a scheduled batch and a continuous stream.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import latest_per_key
from ..session import scratch_path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental file source with a fixed schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _trigger(w, trigger: str):
    if trigger == "availableNow":
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    return w.trigger(processingTime=trigger)


def append_to_table(stream: DataFrame, target: str, checkpoint: str | None = None, fmt: str = "parquet",
                    trigger: str = "availableNow", partition_by: Sequence[str] = ()) -> StreamingQuery:
    """R1/R2/R3 (append): copy a stream into a file table with a checkpoint; returns the started query."""
    cp = checkpoint or scratch_path(stream.sparkSession, "ckpt-append")
    w = stream.writeStream.format(fmt).option("path", target).option("checkpointLocation", cp).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start()


def windowed_counts(stream: DataFrame, time_col: str, window: str, watermark: str,
                    keys: Sequence[str] = (), value_col: str | None = None) -> DataFrame:
    """Tumbling-window aggregate bounded by a watermark (late rows beyond it are dropped, state is
    purged once the watermark passes a window)."""
    aggs = [F.count(F.lit(1)).alias("events")]
    if value_col:
        aggs.append(F.sum(value_col).alias("value_sum"))
    ntz = isinstance(stream.schema[time_col].dataType, T.TimestampNTZType)
    s = stream.withColumn(time_col, F.col(time_col).cast("timestamp")) if ntz else stream  # watermarks need TIMESTAMP
    cast = (lambda c: c.cast("timestamp_ntz")) if ntz else (lambda c: c)
    return (s.withWatermark(time_col, watermark)
            .groupBy(F.window(time_col, window).alias("w"), *keys).agg(*aggs)
            .select(cast(F.col("w.start")).alias("window_start"), cast(F.col("w.end")).alias("window_end"), *keys,
                    *[a for a in ("events", "value_sum") if a == "events" or value_col]))


def distinct_events(stream: DataFrame, identity: Sequence[str], time_col: str, watermark: str) -> DataFrame:
    """Each event once, whatever files bring it: ``dropDuplicatesWithinWatermark`` on its identity.  An event that
    comes again more than ``watermark`` behind the newest one is let through (its state is gone by then); tables that
    are read by key (:func:`read_table`) hold it once all the same."""
    ntz = isinstance(stream.schema[time_col].dataType, T.TimestampNTZType)
    s = stream.withColumn(time_col, F.col(time_col).cast("timestamp")) if ntz else stream  # watermarks need TIMESTAMP
    s = s.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(identity))
    return s.withColumn(time_col, F.col(time_col).cast("timestamp_ntz")) if ntz else s


#: Layout of a streamed table: batches, folds of batches, and for each fold the last batch of each run that is in it.
BATCHES, FOLDS, FOLDED = "batches", "folds", "folded"
WRITTEN = "_written"


def _batch_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(WRITTEN, T.LongType())])


def _write_epochs(stream: DataFrame, root: str, schema: T.StructType, shape: Callable[[DataFrame], DataFrame],
                  checkpoint: str | None, trigger: str, output_mode: str) -> StreamingQuery:
    """Every micro-batch overwrites its own folder ``batches/run=<r>/epoch=<id>``, so a replayed batch is written once.

    The run is named by the checkpoint, which also counts the epochs: two streams into one table never share a folder,
    and a stream that goes on from its checkpoint goes on in its own run.  Rows carry the time at which the batch was
    written, by which readers order batches of different runs."""
    spark = stream.sparkSession
    (spark.createDataFrame([], _batch_schema(schema)).write.mode("ignore")
     .parquet(f"{root}/{BATCHES}/run=none/epoch=-1"))  # readable before any batch
    cp = checkpoint or scratch_path(spark, "ckpt-epochs")
    run = hashlib.md5(cp.rstrip("/").encode()).hexdigest()[:16]

    def write(batch: DataFrame, epoch: int) -> None:
        rows = shape(batch).select(*schema.names, F.lit(time.time_ns() // 1000).alias(WRITTEN))
        rows.write.mode("overwrite").parquet(f"{root}/{BATCHES}/run={run}/epoch={epoch}")

    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", cp).foreachBatch(write)
    return _trigger(w, trigger).start()


def _last_fold(spark: SparkSession, root: str) -> tuple[int | None, list]:
    """The newest fold and its (run, epoch) rows, one per run: metadata of a few rows."""
    try:
        folded = spark.read.schema("run string, epoch long, fold long").parquet(f"{root}/{FOLDED}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, []
    last = folded.agg(F.max("fold")).first()[0]
    return last, folded.where(F.col("fold") == last).collect()


def _read_epochs(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest fold and of the batches after it, with ``epoch`` and ``_written``.  Batches that are in the
    fold are left out by their folders' names, so they are not read."""
    full = T.StructType([*_batch_schema(schema).fields, T.StructField("run", T.StringType()), T.StructField("epoch", T.LongType())])
    batches = spark.read.schema(full).parquet(f"{root}/{BATCHES}")
    fold, done = _last_fold(spark, root)
    if fold is None:
        return batches.drop("run")
    for r in done:
        batches = batches.where((F.col("run") != r.run) | (F.col("epoch") > r.epoch))
    kept = spark.read.schema(T.StructType([*_batch_schema(schema).fields, T.StructField("epoch", T.LongType())]))
    return kept.parquet(f"{root}/{FOLDS}/fold={fold}").unionByName(batches.drop("run"))


def _fold(spark: SparkSession, root: str, schema: T.StructType, newest: Callable[[DataFrame], DataFrame]) -> int:
    """Write the newest row of each key so far as one more fold; returns its number.  The list of what is in the fold is
    written last, so a fold that did not get ready is never read; batches that arrive meanwhile are not in the list."""
    last, before = _last_fold(spark, root)
    fold = 0 if last is None else last + 1
    # the batches that are there now: folder names only
    named = spark.read.schema(T.StructType([T.StructField("run", T.StringType()), T.StructField("epoch", T.LongType())]))
    there = named.parquet(f"{root}/{BATCHES}").groupBy("run").agg(F.max("epoch").alias("epoch")).collect()
    upto = {r.run: r.epoch for r in before} | {r.run: r.epoch for r in there}
    rows = _read_epochs(spark, root, schema)
    newest(rows).select(*schema.names, WRITTEN, "epoch").write.mode("overwrite").parquet(f"{root}/{FOLDS}/fold={fold}")
    done = spark.createDataFrame(sorted(upto.items()) or [], "run string, epoch long")
    done.coalesce(1).write.mode("overwrite").parquet(f"{root}/{FOLDED}/fold={fold}")
    return fold


def upsert_batches(stream: DataFrame, table_root: str, checkpoint: str | None = None, trigger: str = "availableNow",
                   output_mode: str = "update") -> StreamingQuery:
    """R3 (update) + R5: each micro-batch adds the new state of its keys (read with :func:`read_table`)."""
    return _write_epochs(stream, table_root, stream.schema, lambda b: b, checkpoint, trigger, output_mode)


def read_table(spark: SparkSession, table_root: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """Current content of a table written by :func:`upsert_batches`: the latest batch wins per key."""
    return _newest_written(_read_epochs(spark, table_root, schema), keys).drop("epoch", WRITTEN)


def _newest_written(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return latest_per_key(rows, keys, [F.col(WRITTEN), F.col("epoch")])


def compact_table(spark: SparkSession, table_root: str, keys: Sequence[str], schema: T.StructType) -> int:
    """A batch job that folds a table of :func:`upsert_batches` to one row per key; later reads see that fold and
    the batches after it.  Streams may go on meanwhile."""
    return _fold(spark, table_root, schema, lambda rows: _newest_written(rows, keys))


def _change_schema(schema: T.StructType, version_col: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(version_col, T.LongType()),
                         T.StructField("_deleted", T.BooleanType())])


def apply_change_feed(feed_stream: DataFrame, table_root: str, schema: T.StructType, checkpoint: str | None = None,
                      trigger: str = "availableNow", version_col: str = "_commit_version",
                      change_col: str = "_change_type") -> StreamingQuery:
    """Stream a change feed into a keyed table, read with :func:`read_change_table`.

    The table keeps each change's commit version and a tombstone for deletes; a
    key's newest version wins on reading (insert before delete at one version,
    N13), so late, repeated or reordered files cannot roll a key back.
    """
    def changes(b: DataFrame) -> DataFrame:
        return (b.where(F.col(change_col).isin("insert", "update_postimage", "delete"))
                .select(*schema.names, F.col(version_col).cast("bigint").alias(version_col),
                        (F.col(change_col) == "delete").alias("_deleted")))

    return _write_epochs(feed_stream, table_root, _change_schema(schema, version_col), changes, checkpoint, trigger,
                         "append")


def read_change_table(spark: SparkSession, table_root: str, keys: Sequence[str], schema: T.StructType,
                      version_col: str = "_commit_version") -> DataFrame:
    """Live rows of a table written by :func:`apply_change_feed` (tombstones removed)."""
    last = _newest_version(_read_epochs(spark, table_root, _change_schema(schema, version_col)), keys, version_col)
    return last.where(~F.col("_deleted")).select(*schema.names)


def _newest_version(rows: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    prio = F.when(F.col("_deleted"), 0).otherwise(1)
    return latest_per_key(rows, keys, [F.col(version_col), prio, F.col(WRITTEN), F.col("epoch")])


def compact_change_table(spark: SparkSession, table_root: str, keys: Sequence[str], schema: T.StructType,
                         version_col: str = "_commit_version") -> int:
    """Folds a table of :func:`apply_change_feed` to the newest version per key.  Tombstones stay, so that an older
    change that comes late still cannot bring a key back."""
    return _fold(spark, table_root, _change_schema(schema, version_col),
                 lambda rows: _newest_version(rows, keys, version_col))


def change_rows(spark: SparkSession, table_root: str, schema: T.StructType,
                version_col: str = "_commit_version") -> DataFrame:
    """All changes that a table of :func:`apply_change_feed` holds, those before its last fold folded."""
    return _read_epochs(spark, table_root, _change_schema(schema, version_col)).drop("epoch", WRITTEN)


def applied_bookmark(spark: SparkSession, table_root: str, schema: T.StructType, source: str, target: str,
                     version_col: str = "_commit_version") -> DataFrame:
    """The last commit version that has reached a table written by :func:`apply_change_feed`."""
    return bookmarks(_read_epochs(spark, table_root, _change_schema(schema, version_col)), source, target, version_col)


def bookmarks(feed: DataFrame, source: str, target: str, version_col: str = "_commit_version") -> DataFrame:
    """R7 as a table: last applied commit version per (source, target)."""
    return feed.agg(F.max(version_col).alias("last_version")).select(
        F.lit(source).alias("source"), F.lit(target).alias("target"), "last_version")


def run_to_completion(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str | None = None,
                  trigger: str = "availableNow", output_mode: str = "append") -> StreamingQuery:
    cp = checkpoint or scratch_path(stream.sparkSession, "ckpt-fe")
    return _trigger(stream.writeStream.outputMode(output_mode).option("checkpointLocation", cp)
                    .foreachBatch(fn), trigger).start()
