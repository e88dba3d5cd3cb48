"""The registered queries against their SQL counterparts."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from verification.check import connect, difference
from verification.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_counterpart_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) - set(driver.oracle_sql()) == {
        "model_metrics",
        "importances",
        "importances_by_source",
    }


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    mine = driver.queries()[name](spark, SF_DIR).toPandas()
    assert len(mine)
    assert difference(mine, duck.execute(driver.oracle_sql()[name]).df()) is None


def test_entry(spark):
    report = driver.entry(spark)
    assert report.columns == ["section", "item", "count"]
    assert report.count() > 24
