"""The queries that have a SQL form agree with DuckDB."""

import pytest

from compare import compare
from conftest import SF_CHECK
from staysense.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_CHECK), con, ORACLE_SQL[name])
    assert r["cols_match"] and r["rows_match"] and r["values_match"], r


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
