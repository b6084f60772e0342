"""Every query of the library against its DuckDB twin."""

import pytest
from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import connect, difference

from reelmetrics.plans.oracle import ORACLE
from reelmetrics.plans.registry import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_the_entry_registers_all_of_them():
    assert set(QUERIES) <= set(queries())
    assert set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir).toPandas()
    expected = duck.execute(ORACLE[name]).df()
    assert difference(found, expected) is None


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["video_id", "views_count", "likes_count", "minutes_count", "rank"]
    assert result.count() == 10
