"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
import check
from gridseries.plans import catalogue, oracles

QUERIES = catalogue.all_queries()
SQL = oracles.all_sql()
#: A trained network has no SQL; tests/test_network.py holds it against a plain version.
WITHOUT_SQL = {"score_network", "network_metrics", "predict_network"}


@pytest.fixture(scope="module")
def duck(small):
    return check.connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) | WITHOUT_SQL and not WITHOUT_SQL & set(SQL)


def test_all_of_them_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["location_id", "time", "T2M_anom", "T2M_MAX_anom", "T2M_MIN_anom"]
    assert frame.count() == 826


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, small, duck, name):
    ours = QUERIES[name](spark, small).toPandas()
    assert check.difference(ours, duck.execute(SQL[name]).df()) is None
    assert len(ours)
