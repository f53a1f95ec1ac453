"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import enable_checkpoints

PARTITION_ROWS = 1 << 18  # links in a partition, of 16 bytes each


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every linked node the smallest node reachable from it.

    Each round hangs the larger neighbours of a node below its smallest neighbour, then
    every node's smaller neighbours below the smallest of them, until nothing changes.
    Minima combine before the shuffle and joins carry one narrow row for each link, so a
    node with very many links is no group that a task must hold. Rounds are checkpointed
    in the shared folder. Links to oneself, repeated links and nulls are harmless.

    Partitions follow the measured number of links, PARTITION_ROWS each, up to the
    session's: a round over few links writes no file for each two of its partitions.
    """
    enable_checkpoints(links.sparkSession)
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
        .checkpoint()
    )
    parts = 1 + edges.count() // PARTITION_ROWS  # a round never makes more links than it has
    most = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def sized(frame: DataFrame) -> DataFrame:
        return frame.coalesce(parts) if parts < most else frame

    before = None
    while True:
        sides = sized(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            sides.filter(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
        edges = sized(sized(small).filter(F.col("u") != F.col("v")).distinct()).checkpoint()
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = sized(edges).select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return sized(stars.union(roots))
