"""All registered queries against DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.check_oracles import connect, differences
from tremorlane.plans.oracles import ORACLES
from tremorlane.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = queries()[name](spark, SF).toPandas()
    assert len(result) > 0
    assert differences(result, duck.execute(oracle_sql()[name]).df()) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["report", "item", "n"]
