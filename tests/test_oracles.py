"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from oracle import connect, difference

from marquee.registry import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, sf_dir, duck):
    assert difference(QUERIES[name](spark, sf_dir), duck, SQL[name]) is None


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.queries()) >= set(QUERIES)
    assert set(entry_points.oracle_sql()) >= set(SQL)


def test_difference_is_noticed(spark, duck):
    frame = spark.createDataFrame([(1, "a")], "x int, y string")
    assert difference(frame, duck, "SELECT 1 AS x, 'a' AS y") is None
    assert difference(frame, duck, "SELECT 2 AS x, 'a' AS y")
    assert difference(frame, duck, "SELECT 1 AS x, 'a' AS z")
    assert difference(frame, duck, "SELECT 1 AS x, 'a' AS y UNION ALL SELECT 1, 'a'")
