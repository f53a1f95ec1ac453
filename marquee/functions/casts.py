"""Lenient casts for ingest: a value that does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


def to_long(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).try_cast("bigint")


def to_double(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).try_cast("double")


def cast_to_schema(frame: DataFrame, schema: StructType) -> DataFrame:
    """Pick the schema's columns by name (any letter case) and cast each leniently."""
    return frame.select(
        *[
            (F.col(f.name) if isinstance(f.dataType, StringType) else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
