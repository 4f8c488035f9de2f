"""Command line: reconcile two tables and print one JSON report.

    python -m concord.cli LEFT RIGHT [--format parquet] [--keys a,b --keys c] [--out PATH]

LEFT / RIGHT are paths (or table names with ``--format table``).  The report holds the schema status,
row counts, multiset row match, scenario matrix and key diagnostics; every number is computed on the
cluster and only the metric rows reach the driver.  ``--out`` also writes the detail frames as Parquet.
"""

from __future__ import annotations

import argparse
import json
import sys

from .functions import normalize as N
from .operators import compare as C
from .session import get_spark
from .sources import catalog as CT
from .sources import readers as RD


def _rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def reconcile(spark, left, right, key_sets=(), case: str = "upper", strip_suffix_regex: str | None = None,
              drop_prefixes=(), drop_suffixes=()):
    """Technical columns dropped, names normalised (left suffix stripped), then compared."""
    left = N.normalise_names(N.drop_technical_columns(left, drop_prefixes, drop_suffixes), case, strip_suffix_regex)
    right = N.normalise_names(N.drop_technical_columns(right, drop_prefixes, drop_suffixes), case)
    key_sets = [[k.upper() if case == "upper" else k.lower() if case == "lower" else k for k in ks] for ks in key_sets]
    common, l_only, r_only = N.column_sets(left.columns, right.columns)
    left, right = N.align(left, common + l_only), N.align(right, common + r_only)
    schema = C.schema_diff(CT.as_left_catalogue(CT.column_catalogue(spark, {"t": left}, upper=True)),
                           CT.column_catalogue(spark, {"t": right}, upper=True))
    report = {
        "common_columns": common, "left_only_columns": l_only, "right_only_columns": r_only,
        "schema": schema, "counts": C.row_counts(left, right), "row_match": C.row_match(left, right, common),
        "scenarios": C.row_match_scenarios(left, right, common),
    }
    if key_sets:
        report["keys"] = C.key_diagnostics(left, right, key_sets)
    return report


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="concord.cli", description=__doc__.splitlines()[0])
    ap.add_argument("left")
    ap.add_argument("right")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--keys", action="append", default=[], help="comma-separated candidate key (repeatable)")
    ap.add_argument("--out", default=None)
    ap.add_argument("--master", default=None)
    ap.add_argument("--strip-suffix", default=None, help="anchored regex stripped from left column names")
    ap.add_argument("--drop-prefix", action="append", default=[], help="technical column prefix (repeatable)")
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    left, right = RD.scan(spark, a.left, a.format), RD.scan(spark, a.right, a.format)
    rep = reconcile(spark, left, right, [k.split(",") for k in a.keys], strip_suffix_regex=a.strip_suffix,
                    drop_prefixes=a.drop_prefix)
    out = {}
    for k, v in rep.items():
        if hasattr(v, "collect"):
            if a.out:
                v.write.mode("overwrite").parquet(f"{a.out.rstrip('/')}/{k}")
            out[k] = _rows(v)
        else:
            out[k] = v
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
