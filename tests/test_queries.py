"""Bound queries beside their SQL on the smallest tables; the whole set runs in tools/check_oracles.py."""

import glob
import os

import pytest

import __spark_entry__ as entry
from tools.check_oracles import rows_of

FOLDER = entry.SMOKE_DIR
NAMES = [
    "current_state", "bundle_state", "emit_changes", "as_of_join", "merge_intervals", "split_service_hours", "expand_recurrence", "resolve_periods",
    "resolve_rules", "text_flags", "fuzzy_search", "containment_check", "unique_check", "table_diff", "fingerprint_changes", "preserve_ids", "merge_claims",
    "impact_attributes", "compute_impact", "reconcile_periods", "edges", "path_features", "departures", "next_arrivals", "usage_cost", "regression_eval",
]


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables absent")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_contract():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 90
