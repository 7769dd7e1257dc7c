"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_every_query_has_sql():
    # those of the optional subpackage that SQL cannot express have tests of their own
    assert {n for n in set(QUERIES) - set(ORACLES) if not n.startswith("op") and n != "pipeline"} == set()


def test_entry(spark):
    profile = {r["variable"]: r for r in contract.entry(spark).collect()}
    assert set(profile) == {
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"}
    assert profile["o_orderkey"]["count"] == spark.read.parquet(f"{SF}/orders.parquet").count()
