"""Every registered query beside its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from oracle_check import compare, connect

import __spark_entry__ as contract
from ticketmill import registry


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) == []


def test_every_query_of_the_models_has_sql():
    named = registry.load()
    assert all(q.sql for q in named.values())
    assert set(named) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert sum(r["total"] for r in rows) == 759
    assert sum(r["overdue"] for r in rows) == 611 and sum(r["on_track"] for r in rows) == 148
