"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

from tools.check import compare, duck

SF = "/root/testdata/sf0.001"


def _names():
    from __spark_entry__ import queries
    return sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries
    res = compare(spark, SF, name, queries()[name], oracle_sql().get(name), con)
    assert res["status"] in ("ok", "no-oracle"), res


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
