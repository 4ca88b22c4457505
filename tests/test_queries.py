"""Every registered query beside its SQL twin."""

import pytest

import __spark_entry__ as entry_point
from clipwire.checks.compare import connect, difference
from clipwire.checks.oracle import oracles
from clipwire.checks.registry import registered


@pytest.fixture(scope="module", params=["0.001", "0.01"])
def tables(request):
    sf_dir = f"/root/testdata/sf{request.param}"
    con = connect(sf_dir)
    yield sf_dir, con
    con.close()


def test_every_query_has_a_twin():
    assert set(oracles()) == set(registered())
    assert set(registered()) <= set(entry_point.queries())
    assert set(registered()) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registered()))
def test_same_rows(spark, tables, name):
    sf_dir, con = tables
    assert difference(spark, con, sf_dir, name) is None
