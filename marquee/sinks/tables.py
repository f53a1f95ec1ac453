"""Table sink, independent of the storage format."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(
    frame: DataFrame,
    target: str | None,
    *,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    options: dict[str, str] | None = None,
    catalog: bool = False,
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Write to a path, or to a catalog table when ``catalog`` is set; without target by options alone.

    Connector settings (table, keyspace, ...) go in ``options``. A bucketed catalog
    table lets later joins on the bucket column skip their shuffle.
    """
    writer = frame.write.format(fmt).mode(mode).options(**(options or {}))
    if bucket_by:
        count, column = bucket_by
        writer = writer.bucketBy(count, column).sortBy(column)
    if catalog or bucket_by:
        writer.saveAsTable(target)
    else:
        writer.save(target) if target else writer.save()
