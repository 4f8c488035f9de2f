"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.session import scratch_path

#: A word is a maximal run of characters that are none of these six whitespace characters.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession | None = None) -> None:
    """Make this package importable in the session's Python workers, wherever they run: once per Spark context its
    sources go out as a zip file with the jobs.  Unless the session has chosen a size for Arrow batches, they are made
    smaller, for rows here are whole texts."""
    spark = spark or SparkSession.active()
    sc = spark.sparkContext
    if spark.conf.get(ARROW_ROWS) == "10000":  # Spark's default
        spark.conf.set(ARROW_ROWS, "2000")
    if getattr(sc, "_concord_sources", None):
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="concord-src-")) / "concord.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))  # served by the driver; no shared folder is involved
    sc._concord_sources = str(archive)


def vector_udf(fn: Callable, result: str) -> Callable[..., Column]:
    """A pandas UDF whose function may use this package."""
    ship()
    return F.pandas_udf(fn, result)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder named by spark.checkpoint.dir and read it back (cuts the lineage)."""
    spark = df.sparkSession
    ship(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, with NULL as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the decimal text of ``doc_id`` modulo ``mod``; NULL ids count as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(mod)).cast("int")


def unit_hash(seed: str, *parts: Column) -> Column:
    """A reproducible number in (0, 1) from the MD5 of the parts: 52 bits, the same in any SQL engine."""
    key = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2 ** 52))


def unit_hash_sql(seed: str, part: str) -> str:
    """The DuckDB text of :func:`unit_hash` with one part."""
    return (f"((CAST(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST({part} AS VARCHAR), '')), 1, 13) AS BIGINT)"
            f" AS DOUBLE) + 0.5) / {float(2 ** 52)!r})")
