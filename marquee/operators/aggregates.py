"""Aggregations that are not reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def next_user_id(ratings: DataFrame) -> DataFrame:
    """One row: the id after the largest in use."""
    return ratings.agg((F.max("userid") + 1).alias("userid"))


def one_rating_per_pair(ratings: DataFrame) -> DataFrame:
    """Restore the grain of one rating per user and movie by averaging repeats.

    The averages combine map-side, so a pair copied many times travels once per task.
    """
    return ratings.groupBy("userid", "movieid").agg(F.avg("rating").alias("rating"))


def distinct_rows(frame: DataFrame) -> DataFrame:
    return frame.distinct()


def rmse(
    predictions: DataFrame,
    label: str = "rating",
    prediction: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """One row: root mean squared error, optionally of rows that each stand for several.

    Rows without a label or a prediction count on neither side of the mean.
    """
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    weight_of = F.when(error.isNotNull(), F.col(weight) if weight else F.lit(1.0))
    return predictions.agg(F.sqrt(F.sum(weight_of * error * error) / F.sum(weight_of)).alias("rmse"))
