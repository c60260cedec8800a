"""Oracle parity at sf0.01 for every SQL-checkable query (the driver's gate)."""

import pytest

import __spark_entry__ as E
from compare import compare
from conftest import SF_CHECK

SLOW = {"smote_points", "tomek_links", "nearest_neighbors", "smote_tomek_balance"}
NAMES = sorted(n for n in E.oracle_sql() if n not in SLOW)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(E.queries()[name](spark, SF_CHECK), con, E.oracle_sql()[name])
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows_match"], (r["spark_rows"], r["oracle_rows"])
    assert r["values_match"], r["first_diffs"]


@pytest.mark.parametrize("name", sorted(SLOW))
def test_neighbour_queries_match_brute_force(spark, con, name):
    r = compare(E.queries()[name](spark, SF_CHECK), con, E.oracle_sql()[name])
    assert r["rows_match"] and r["values_match"], r.get("first_diffs")


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["total_bookings"] > 0
    assert set(E.oracle_sql()) <= set(E.queries())
