"""First rows of a frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def preview(frame: DataFrame, n: int = 20, order_by: list[Column | str] | None = None) -> DataFrame:
    """First ``n`` rows, in the given order when one is stated."""
    return (frame.orderBy(*order_by) if order_by else frame).limit(n)
