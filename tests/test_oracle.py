"""Every registered query against its SQL on the smallest tables."""

import oracle_check
import pytest

import __spark_entry__ as contract
from tramlag.registry import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    assert oracle_check.compare(df, con, contract.oracle_sql()[name]) is None


def test_results_do_not_depend_on_the_session_zone(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ["a3_line_1d", "d4_date", "r_facts", "t2_run_retention", "a11_refresh_window"]:
            df = contract.queries()[name](spark, SF)
            assert oracle_check.compare(df, con, contract.oracle_sql()[name]) is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    assert contract.entry(spark).count() > 0
