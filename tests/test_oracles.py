"""Every registered query equals its SQL on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallywatch.plans.oracles import ORACLES
from tallywatch.plans.registry import QUERIES
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    outcome = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
    assert not outcome, outcome


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
