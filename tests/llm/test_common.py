import hashlib
import zipfile
import zlib

from pyspark.sql import functions as F

from concord.llm.common import materialize, remainder, ship, unit_hash, word_count


def test_hashes_and_counts(spark):
    df = spark.createDataFrame([(i, " a\tb\x0bc  d\n" * (i % 3)) for i in range(50)] + [(None, None)], "i long, t string")
    rows = df.select("i", remainder(F.col("i"), 3).alias("r"), unit_hash("s", F.col("i")).alias("u"),
                     word_count(F.coalesce("t", F.lit(""))).alias("n")).collect()
    for r in rows:
        name = "" if r.i is None else str(r.i)
        assert r.r == zlib.crc32(name.encode()) % 3
        assert r.u == (int(hashlib.md5(f"s:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        assert r.n == (0 if r.i is None else 4 * (r.i % 3))


def test_written_tables_lie_in_the_shared_folder(spark):
    df = spark.range(5).withColumn("x", F.lit(None).cast("string"))
    back = materialize(df, "t")
    assert back.schema["x"].dataType == df.schema["x"].dataType and back.count() == 5
    plain = lambda p: "/" + p.removeprefix("file:").lstrip("/")
    assert plain(back.inputFiles()[0]).startswith(plain(spark.sparkContext.getCheckpointDir()))


def test_sources_go_out_once(spark):
    ship(spark)
    sent = spark.sparkContext._concord_sources
    ship(spark)
    assert spark.sparkContext._concord_sources == sent
    names = zipfile.ZipFile(sent).namelist()
    assert "concord/__init__.py" in names and "concord/llm/jaccard.py" in names
