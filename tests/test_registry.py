from __future__ import annotations

import sys

import pytest
from conftest import DATA
from oracle_check import connect, differences

import __spark_entry__ as driver
from postflow.plans.oracle import ORACLE
from postflow.plans.registry import QUERIES

SMALL = str(DATA / "sf0.001")


@pytest.fixture(scope="module")
def database():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_only_the_part_for_training_data_may_be_missing(monkeypatch):
    """Without that part the other queries are left; any other missing module is an error."""
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(driver.queries()) == set(QUERIES)
    assert set(driver.oracle_sql()) == set(ORACLE)
    monkeypatch.setattr(driver, "REMOVABLE", ("another",))
    with pytest.raises(ModuleNotFoundError):
        driver.queries()


def test_entry(spark):
    assert driver.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    assert differences(spark, database, name, SMALL) is None
