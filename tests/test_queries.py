"""Every registered query against its SQL, on the smallest tables; queries without SQL are tested elsewhere."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference, duck_rows, spark_rows
from tierloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {"retrieve_lsh"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    got, want = spark_rows(QUERIES[name](spark, SF)), duck_rows(duck, ORACLES[name])
    assert difference(got, want) is None


def test_only_the_named_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


def test_entry(spark):
    got = entry.entry(spark)
    assert got.columns[-1] == "target_tier" and got.count() == 150
