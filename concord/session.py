"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "concord", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and UTC session time zone."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def check_local(master: str) -> None:
    """A folder of the driver's machine only serves a session whose executors run in the driver."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"master {master!r} needs spark.checkpoint.dir: a folder that all executors share")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder (HDFS/S3/ABFS) and is used
    as is.  Only when it is unset (local tests) a folder under the local temp
    directory is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        check_local(sc.master)
        configured = tempfile.mkdtemp(prefix="concord-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written intermediates."""
    import uuid

    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, target_partition_bytes: int = 128 * 1024 * 1024,
               max_split_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of input (e.g. 100 TB on a large cluster).

    The initial shuffle partition count is sized so each partition holds about
    ``target_partition_bytes``; AQE then coalesces small partitions and splits
    skewed ones at run time against the same advisory size.  Scan splits are
    capped at ``max_split_bytes`` so a task's input fits executor memory.
    """
    parts = max(200, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
    }
