"""Plan-shape guards: no cartesian products anywhere, pushdown and pruning where expected, one shuffle
for the row match."""

import contextlib
import io

import pytest

from concord.plans import QUERIES
from tests.conftest import SMALL


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_products_or_python(spark, name):
    text = plan_text(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "EvalPython" not in text and "FlatMapGroupsInPandas" not in text  # no Python in the hot path


def test_row_match_single_shuffle(spark):
    text = plan_text(QUERIES["row_match"](spark, SMALL))
    exchanges = [line for line in text.splitlines() if line.strip().startswith("(") and "Exchange" in line]
    # one hash exchange on the fingerprint, one single-partition exchange for the final metrics
    assert len(exchanges) == 2, exchanges


def test_scan_pushdown_and_pruning(spark):
    text = plan_text(QUERIES["capped_scan"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_partition_pruning(spark):
    from concord.session import scratch_path
    from concord.sources import sinks as SK

    path = scratch_path(spark, "pruned-fact")
    SK.write_partitioned_fact(spark.read.parquet(f"{SMALL}/lineitem.parquet"), path, "l_shipdate")
    text = plan_text(spark.read.parquet(path).where("event_month in ('1997-01', '1997-02')"))
    assert "PartitionFilters: [event_month" in text and "IN (1997-01,1997-02)" in text


def scans(name, spark):
    text = plan_text(QUERIES[name](spark, SMALL))
    return sum(line.startswith("(") and ") Scan parquet" in line for line in text.splitlines())


def test_sides_are_scanned_once(spark):
    assert scans("row_match_scenarios", spark) == 2  # one per side
    assert scans("delta_load", spark) == 2  # the target, and the orders its feed is derived from
    assert scans("watermark_load_all_keys", spark) <= 3  # target, source, and the watermark's maximum


def test_dedup_reads_but_never_shuffles_the_text(spark):
    text = plan_text(QUERIES["dedup_documents"](spark, SMALL))
    exchange = text[text.index("Exchange\n"):]
    assert "text#" not in exchange.split("\n\n")[0]
