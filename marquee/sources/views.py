"""SQL text over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_views(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text against the frames, each visible under its keyword name.

    The views exist only while the text is analysed; the result stays lazy. A
    temporary view that already had the name is put back afterwards.
    """
    catalog = spark.catalog
    held = {
        name: spark.table(name)
        for name in tables
        if catalog.tableExists(name) and catalog.getTable(name).isTemporary
    }
    try:
        for name, frame in tables.items():
            frame.createOrReplaceTempView(name)
        return spark.sql(text)
    finally:
        for name in tables:
            catalog.dropTempView(name)
        for name, frame in held.items():
            frame.createOrReplaceTempView(name)
