"""Every query with SQL against DuckDB, and every other query for a result."""

import pytest

import __spark_entry__ as contract
from statloom.plans.catalogue import REGISTRY
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def duck(root):
    return connect(root)


@pytest.mark.parametrize("name", [n for n, e in REGISTRY.items() if e.sql])
def test_matches_sql(spark, root, duck, name):
    entry = REGISTRY[name]
    assert differences(entry.run(spark, root), duck, entry.sql) == []


@pytest.mark.parametrize("name", [n for n, e in REGISTRY.items() if not e.sql])
def test_gives_rows(spark, root, name):
    assert REGISTRY[name].run(spark, root).count() > 0


def test_every_inventory_item_is_named_once_at_least():
    assert all(e.covers for e in REGISTRY.values())


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
