"""Tables from values the caller already holds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from marquee.schemas import RATINGS


def value_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """Typed frame from in-memory rows; an empty list gives an empty frame."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def rating_rows(spark: SparkSession, userid: int, movieids: Iterable[int], rating: float = 5.0) -> DataFrame:
    """Ratings of one user for movie ids typed in by hand."""
    return spark.createDataFrame([(userid, movieid, float(rating)) for movieid in movieids], RATINGS)
