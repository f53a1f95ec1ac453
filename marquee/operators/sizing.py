"""Broadcast behind a measurement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

# Largest table sent whole to every executor.
BROADCAST_LIMIT = 200 * 1024 * 1024

_ROW_OVERHEAD = 32
_CELL = 8


def stored_bytes(frame: DataFrame) -> int:
    """Bytes the rows take in memory, added up where the rows are.

    Texts and binaries count with their length, nested values with that of their JSON form.
    """
    flat = [F.col(f.name) for f in frame.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    nested = [
        F.to_json(F.struct(F.col(f.name)))
        for f in frame.schema.fields
        if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))
    ]
    texts = flat + nested
    fixed = F.lit(_ROW_OVERHEAD + _CELL * len(frame.columns))
    width = reduce(lambda total, c: total + F.coalesce(F.octet_length(c), F.lit(0)), texts, fixed)
    return frame.agg(F.sum(width).alias("bytes")).first().bytes or 0


def broadcast_if_small(frame: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Mark the frame for broadcast if its measured size allows, else leave the join to Spark.

    Catalyst cannot tell the size of a join's result beforehand, so a small dimension
    that is itself a join would have the ratings shuffled to meet it. One extra pass
    over the dimension saves that shuffle; a larger dimension is sorted and merged.
    """
    return F.broadcast(frame) if stored_bytes(frame) <= limit else frame
