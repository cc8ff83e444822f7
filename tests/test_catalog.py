"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest
from conftest import plan_of
from oracle import compare, connect

import __spark_entry__ as contract
from reportloom.catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_the_contract_holds_the_catalog():
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    sql = ORACLE.get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(duck, sql, df) is None
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "BatchEvalPython" not in plan


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["year", "month"] and df.count() > 0


def test_inventory_is_covered():
    counts = {"s": 12, "p": 21, "f": 17, "j": 5, "a": 25, "w": 7, "l": 6, "u": 4, "t": 7, "m": 2, "x": 2, "e": 10}
    ids = {name.split("_")[0] for name in QUERIES}
    assert ids == {f"{family}{i:02d}" for family, n in counts.items() for i in range(1, n + 1)}
