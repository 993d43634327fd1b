"""Every registered query against its reference SQL on the smallest data folder."""

import pytest

import __spark_entry__ as spark_entry
from ledgermill.catalog import load
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
RUNNERS, ORACLES = load().RUNNERS, load().ORACLES



@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(RUNNERS))
def test_query_matches_reference_sql(spark, duck, name):
    verdict, _ = compare(spark, duck, FOLDER, name, RUNNERS[name], ORACLES.get(name))
    assert verdict.startswith("ok"), verdict
    assert "NESTED" not in verdict


def test_every_query_has_reference_sql():
    assert set(RUNNERS) == set(ORACLES)


def test_entry_holds_all_of_them():
    assert set(RUNNERS) <= set(spark_entry.queries()) and set(ORACLES) <= set(spark_entry.oracle_sql())


def test_entry_runs(spark):
    assert spark_entry.entry(spark).count() > 0
