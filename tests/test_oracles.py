"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from check_oracles import compare
from concord.plans import QUERIES
from tests.conftest import SMALL

NAMES = sorted(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, duck, name, E.queries()[name], E.oracle_sql().get(name), SMALL)
    if E.oracle_sql().get(name) is None:
        assert res["rows"] >= 0
    else:
        assert res["ok"], res.get("why")
        assert res.get("schema_ok", True), res.get("types")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    r = rows[0]
    # survey's slice numbers at sf0.001
    assert (r.left_rows, r.right_rows, r.matched_rows, r.only_left_rows, r.only_right_rows) == (6000, 5992, 5933, 67, 59)


def test_every_query_has_survey_ids():
    from concord.plans import SURVEY_IDS
    assert set(SURVEY_IDS) == set(QUERIES) <= set(E.queries())
    assert all(SURVEY_IDS[n] for n in SURVEY_IDS)
