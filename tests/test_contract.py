"""Every registered query with an oracle must agree with it on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_oracle import connect, rows_of
from voltide.plans.catalog import MODULES, ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_catalog_is_consistent():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) == sum(len(m.QUERIES) for m in MODULES)
    assert QUERIES.keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, duck, sf_dir, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
