"""Every registered query with an SQL twin matches DuckDB on the small tables."""

import pytest

import __spark_entry__ as entry
from netsift.plans.compare import compare

ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, sf_small, name):
    df = entry.queries()[name](spark, sf_small)
    res = compare(df, ORACLE[name], sf_small)
    assert res["cols_match"], res
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["values_match"], {k: v for k, v in res.items() if k.startswith("only")}


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) <= set(entry.queries())
