"""Every registered query against its DuckDB oracle (the driver's correctness gate), at sf0.001."""

import pytest

import __spark_entry__ as E
from check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    if name not in ORACLES:
        assert len(got.columns) > 0
        return
    ok, msg = compare(got, con.execute(ORACLES[name]).df())
    assert ok, msg


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["uid", "utype", "cid", "att1", "att2", "att3", "ad"]
