"""Shards of bounded size by extendible hashing.

A directory over the leading bits of a row's hash starts with one bucket; only buckets
over the byte limit split on their next bit. Bits are looked at in steps of ``STEP``: one
aggregate gives the bytes of every cell of 2^STEP cells, and the depth of a cell's bucket
is the smallest at which its ancestor fits. Only rows of cells that are still too large
go on to the next step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.sizing import broadcast_if_small
from marquee.session import enable_checkpoints

SHARD_BYTES = 16 << 20
STEP = 10  # bits looked at in one pass
HASH_BITS = 60  # bits used of each of the two hashes
DIRECTORY_BYTES = 32 << 20  # directories up to this size are broadcast, larger ones joined by a shuffle


def _bits(step: int) -> Column:
    """The ``STEP`` bits that a row's cell has in the given step, as a number.

    The first hash is that of the id; rows that agree in all of it (copies of a row)
    differ in the second, which is that of the row's number.
    """
    per = HASH_BITS // STEP
    word = F.col("h1") if step < per else F.col("h2")
    return F.shiftrightunsigned(word, 64 - STEP * (step % per + 1)).bitwiseAND(F.lit((1 << STEP) - 1).cast("long"))


def _cell_depths(cells: DataFrame, limit: int) -> DataFrame:
    """(bucket, bits, depth) of cells (bucket, bits, bytes, rows): bits of the step that the cell's
    shard uses, null where even the cell itself is too large.

    Sums shrink as bits are added, so the first depth that fits is where splitting ends.
    """
    depth = F.explode(F.sequence(F.lit(0), F.lit(STEP))).alias("depth")
    ancestors = cells.select("bucket", "bits", "bytes", "rows", depth).withColumn(
        "head", F.expr(f"shiftright(bits, {STEP} - depth)")
    )
    sizes = ancestors.groupBy("bucket", "depth", "head").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    fitting = sizes.filter((F.col("bytes") <= limit) | (F.col("rows") == 1)).select("bucket", "depth", "head")
    first = (
        ancestors.join(fitting, ["bucket", "depth", "head"]).groupBy("bucket", "bits").agg(F.min("depth").alias("depth"))
    )
    return cells.select("bucket", "bits").join(first, ["bucket", "bits"], "left")


def assign_shards(
    docs: DataFrame, *, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows (id, n_bytes, shard, depth), one for each input row, and the columns in ``keep``.

    ``shard`` is the bucket's bits (``-`` if all rows fit one shard), ``depth`` their number;
    ``n_bytes`` the text's UTF-8 bytes. The texts of a shard have ``limit`` bytes at most; a
    text that is longer by itself has a shard of its own.

    A null or empty text has 0 bytes. Rows with equal ids stay together unless they exceed
    a shard; then the bits of a second hash, that of the row's number, split them, copies
    included. Null ids count as one id. An empty table gives an empty result; columns
    called like the result's are not looked at unless kept under their own name.
    """
    clashing = {"n_bytes", "shard", "depth"} & set(keep)
    if clashing:
        raise ValueError(f"columns {sorted(clashing)} cannot be kept under names of the result")
    enable_checkpoints(docs.sparkSession)
    number = F.monotonically_increasing_id()  # fixed by the checkpoint
    left = docs.select(
        F.col(id_col).alias("__id"),
        F.struct(*(docs[c] for c in keep)).alias("__kept") if keep else F.lit(None).cast("int").alias("__kept"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("bytes"),
        F.xxhash64(F.col(id_col)).alias("h1"),
        F.xxhash64(number).alias("h2"),
        F.lit("").alias("bucket"),
    ).checkpoint()
    done = []
    for step in range(2 * HASH_BITS // STEP):
        rows = left.withColumn("bits", _bits(step))
        cells = rows.groupBy("bucket", "bits").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        directory = _cell_depths(cells.checkpoint(), limit).checkpoint()
        found = rows.join(broadcast_if_small(directory, DIRECTORY_BYTES), ["bucket", "bits"])
        text = F.lpad(F.bin("bits"), STEP, "0")
        done.append(
            found.filter(F.col("depth").isNotNull()).withColumn("shard", F.concat("bucket", F.expr(f"substring(lpad(bin(bits), {STEP}, '0'), 1, depth)")))
        )
        if directory.filter("depth IS NULL").isEmpty():
            break
        left = found.filter(F.col("depth").isNull()).withColumn("bucket", F.concat("bucket", text)).drop("bits", "depth").checkpoint()
    whole = reduce(DataFrame.unionByName, done)
    return whole.select(
        F.col("__id").alias(id_col),
        F.col("bytes").alias("n_bytes"),
        F.when(F.col("shard") == "", "-").otherwise(F.col("shard")).alias("shard"),
        F.length("shard").cast("int").alias("depth"),
        *(F.col("__kept")[c].alias(c) for c in keep if c != id_col),
    )


def write_shards(docs: DataFrame, path: str, *, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write every column of ``docs`` as Parquet, one folder ``shard=...`` for each shard."""
    keep = tuple(c for c in docs.columns if c != id_col)
    shards = assign_shards(docs, limit=limit, id_col=id_col, text_col=text_col, keep=keep)
    shards.drop("n_bytes", "depth").repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)
