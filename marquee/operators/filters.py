"""Row filters, membership tests and the emptiness test."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.matching import genre_matches, title_matches


def search_titles(movies: DataFrame, keyword: str, literal: bool = False) -> DataFrame:
    """(movieid, title) of the movies whose title contains the keyword, any letter case."""
    return movies.filter(title_matches(keyword, "title", literal)).select("movieid", "title")


def filter_genre(movies: DataFrame, genre: str) -> DataFrame:
    return movies.filter(genre_matches(genre))


def with_listed_ids(frame: DataFrame, ids: DataFrame, key: str = "movieid") -> DataFrame:
    """Rows whose key occurs in ``ids``."""
    return frame.join(ids.select(key), key, "left_semi")


def without_listed_ids(frame: DataFrame, ids: DataFrame, key: str = "movieid") -> DataFrame:
    """Rows with a key that does not occur in ``ids``; a null key is in no list and out of it alike."""
    return frame.filter(F.col(key).isNotNull()).join(ids.select(key), key, "left_anti")


def drop_null_keys(frame: DataFrame, key: str) -> DataFrame:
    """Keep rows with a group key; stated before the grouping so that it reaches the scan."""
    return frame.filter(F.col(key).isNotNull())


def drop_null_aggregates(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Keep groups for which every listed aggregate has a value; NaN is one."""
    return frame.filter(reduce(and_, (F.col(c).isNotNull() for c in columns)))


def any_rows(frame: DataFrame, name: str = "found") -> DataFrame:
    """One row telling whether the frame has any; each task stops at its first row."""
    return frame.limit(1).agg((F.count(F.lit(1)) > 0).alias(name))
