"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, entry.queries()[name], entry.oracle_sql().get(name), SF, con)
    assert r["status"] in ("ok", "rows-only"), r["status"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]
