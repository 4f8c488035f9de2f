"""A corpus pipeline of five of the operators: each stage works on all documents that the one before it kept.

quality       documents that the weakly supervised quality scorer rejects go
near_copies   one document stays of each class of near duplicates
repeats       strings of 100 bytes that start earlier in the corpus are taken out of the texts
benchmark     documents that hold a benchmark item, give or take a few edits, go
mixture       sources are mixed to target weights: how many copies of which document are taken

All stages but the last return the columns of documents, rows in no order.  NULL and empty texts are rejected by the
first stage; the other stages would keep them.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import decontaminate, jaccard, mixing, suffix, weak
from concord.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weak.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each_class(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = suffix.strip_repeats(docs)
    if "n_chars" in out.columns:  # it describes the text
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.pareto_mix(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("benchmark", benchmark),
    ("mixture", mixture),
]

#: SQL cannot express the first stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
