"""Every registered query against its equivalent SQL, or for rows where it has none."""

import pytest

import __spark_entry__ as driver
from claimwright.plans import learning, registry
from tests.compare import differences, duck

SQL = registry.oracle_sql()
RUNS = registry.queries()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, connection, name):
    assert differences(RUNS[name](spark, sf_dir), connection, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(SQL)))
def test_gives_rows(spark, sf_dir, name, monkeypatch):
    """Models of full size, on fewer labelled rows."""
    monkeypatch.setattr(learning, "TRAIN_ROWS", 300)
    assert not RUNS[name](spark, sf_dir).isEmpty()


def test_driver_has_every_query():
    assert set(RUNS) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 1
