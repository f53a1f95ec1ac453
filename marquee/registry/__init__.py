"""Every query by name, and for most of them the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marquee.registry import curation, recommendation, relational, reports, storage

Query = Callable[[SparkSession, str], DataFrame]

_GROUPS = (curation, reports, relational, recommendation, storage)


def all_queries() -> dict[str, Query]:
    return {name: query for group in _GROUPS for name, query in group.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: text for group in _GROUPS for name, text in group.SQL.items()}
