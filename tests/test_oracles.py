"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = os.environ.get("GEOQA_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF)
    assert r.get("ok") is not False, r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["osm_id", "insee", "lon", "lat"]
    assert df.count() >= 0
