"""Compression of vectors to codes: a codebook for each part of the vector, searched through a trie.

Components become integers, vectors are cut into equal parts, and each part is replaced by
the index of the nearest entry of its position's codebook. Codebooks start as the parts of
the first vectors and are improved by rounds of assignment and averaging.

Every task looks up the distinct parts of its rows in lexicographic order, which is a
depth-first walk of their trie: a node's vector of distances to all entries is that of its
parent plus one dimension, computed once for all parts that share the prefix. Subtrees of
up to BLOCK leaves are walked level by level in numpy. Leaves take the nearest entry and
add their parts, weighted by how often they occur, to the entry's sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.sizing import broadcast_if_small
from marquee.session import enable_checkpoints, scratch_path

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
LARGEST = 1 << 18  # components beyond have no code: sums of squares would leave 64 bits
BLOCK = 2048  # leaves whose distance vectors are held at a time
SALTS = 64
BROADCAST_BYTES = 64 << 20


def distinct_parts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct rows in lexicographic order, index of each row among them, their numbers)."""
    order = np.lexsort(rows.T[::-1]) if rows.shape[1] else np.arange(len(rows))
    ordered = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    place = np.cumsum(new) - 1
    inverse = np.empty(len(rows), np.int64)
    inverse[order] = place
    return ordered[new], inverse, np.bincount(place, minlength=int(new.sum()))


def nearest_entries(parts: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of distinct parts in lexicographic order; ties go to the lower index."""
    width = parts.shape[1]
    entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    root = np.zeros(len(codebook), np.int64)
    stack = [(0, len(parts), 0, root)] if len(parts) and width else []
    while stack:
        low, high, depth, shared = stack.pop()
        if high - low > BLOCK and depth < width - 1:
            column = parts[low:high, depth]
            begin = np.concatenate(([0], np.flatnonzero(column[1:] != column[:-1]) + 1))
            end = np.append(begin[1:], high - low)
            for s, e in zip(begin[::-1], end[::-1]):  # the first child comes off the stack first
                stack.append((low + s, low + e, depth + 1, shared + (column[s] - codebook[:, depth]) ** 2))
            continue
        for start in range(low, high, BLOCK):
            own = parts[start : min(high, start + BLOCK)]
            node = np.zeros(len(own), np.int64)  # node of each leaf on the level above
            new = np.zeros(len(own), bool)
            new[0] = True
            total = shared[None, :]
            for d in range(depth, width):
                new[1:] |= own[1:, d] != own[:-1, d]
                first = np.flatnonzero(new)
                total = total[node[first]] + (own[first, d, None] - codebook[None, :, d]) ** 2
                node = np.cumsum(new) - 1
            best = total.argmin(1)
            entry[start : start + len(own)] = best[node]
            distance[start : start + len(own)] = total[np.arange(len(best)), best][node]
    return entry, distance


def _matrix(column: pa.Array) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _assigned(batch: pa.RecordBatch, at: int, codebooks: np.ndarray):
    """For each part position its distinct parts, their index by row, numbers, entries and distances."""
    rows = _matrix(batch.column(at))
    width = codebooks.shape[2]
    for p, codebook in enumerate(codebooks):
        parts, inverse, times = distinct_parts(rows[:, p * width : (p + 1) * width])
        yield (p, parts, inverse, times, *nearest_entries(parts, codebook))


def integer_vectors(vectors: DataFrame, vector_col: str, scale: int = SCALE) -> DataFrame:
    """The rows whose vector is complete, with it as integers floor(scale * x) in place.

    Vectors that are null or hold null or non-finite components, or some larger than LARGEST, go.
    """
    usable = F.forall(vector_col, lambda x: F.coalesce(F.abs(x.cast("double")) <= LARGEST, F.lit(False)))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    return vectors.filter(F.col(vector_col).isNotNull() & usable).withColumn(vector_col, whole)


def train_codebooks(
    kept: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> np.ndarray:
    """Codebooks (part, entry, position) of integer vectors.

    They start as the parts of the ``entries`` vectors of smallest id (equal ids by their
    components) that are as long as the very first; rows without id train but do not start.
    Entries and their sums, at most entries * dimensions numbers, are all that the driver sees.
    No codebook (zero entries) comes out if there is no such vector or its length is not a
    multiple of ``parts``.
    """
    spark = kept.sparkSession
    rows = kept.select(F.col(id_col).alias("own_id"), F.col(vector_col).alias("own_vector"))
    given = rows.filter(F.col("own_id").isNotNull())
    first = given.orderBy("own_id", "own_vector").limit(1).collect()
    dims = len(first[0].own_vector) if first else 0
    if not dims or dims % parts:
        return np.zeros((parts, 0, 0), np.int64)
    alike = F.size("own_vector") == dims
    start = given.filter(alike).orderBy("own_id", "own_vector").limit(entries).collect()
    width = dims // parts
    codebooks = np.array([r.own_vector for r in start], np.int64).reshape(len(start), parts, width).transpose(1, 0, 2).copy()

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(codebooks)

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codebooks = shared.value
            sums, number = np.zeros_like(codebooks), np.zeros(codebooks.shape[:2], np.int64)
            for batch in batches:
                for p, found, _, times, entry, _ in _assigned(batch, 0, codebooks):
                    np.add.at(sums[p], entry, found * times[:, None])
                    np.add.at(number[p], entry, times)
            part, entry = np.nonzero(number)
            columns = [part, entry, number[part, entry]]
            lists = pa.array(list(sums[part, entry]), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), lists], names=["part", "entry", "n", "sums"])

        partial = rows.filter(alike).select("own_vector").mapInArrow(add_up, "part long, entry long, n long, sums array<long>")
        whole = (
            partial.select("part", "entry", "n", F.posexplode("sums").alias("at", "value"))
            .groupBy("part", "entry", "at")
            .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
        )
        for r in whole.collect():
            codebooks[r.part, r.entry, r["at"]] = int(r.total) // int(r.n)
        shared.unpersist()
    return codebooks


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode_vectors(
    kept: DataFrame, codebooks: np.ndarray, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """Rows (id, label, code, error): entry indexes in hexadecimal, two digits a part, and the summed squared distance.

    Vectors of another length than the codebooks' have neither code nor error.
    """
    parts, entries, width = codebooks.shape
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits for an entry")
    shared = kept.sparkSession.sparkContext.broadcast(codebooks)
    rows = kept.select(F.col(id_col).alias("own_id"), F.col(label_col).alias("own_label"), F.col(vector_col).alias("own_vector"))
    fits = (F.size("own_vector") == parts * width) & F.lit(entries > 0)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codebooks = shared.value
        for batch in batches:
            code = np.zeros((batch.num_rows, len(codebooks)), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for p, _, inverse, _, entry, distance in _assigned(batch, 2, codebooks):
                code[:, p] = entry[inverse]
                error += distance[inverse]
            text = code.tobytes().hex()
            step = 2 * len(codebooks)
            codes = pa.array([text[i * step : (i + 1) * step] for i in range(batch.num_rows)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes, pa.array(error)], names=["own_id", "own_label", "code", "error"])

    kinds = dict(rows.dtypes)
    schema = f"own_id {kinds['own_id']}, own_label {kinds['own_label']}, code string, error long"
    none = rows.filter(~fits).select("own_id", "own_label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = rows.filter(fits).mapInArrow(encode, schema).unionByName(none)
    return coded.withColumnsRenamed({"own_id": id_col, "own_label": label_col})


def _with_label_error(coded: DataFrame, salt_key: Column, limit: int) -> DataFrame:
    """The rows with the summed error of their label; nulls are one label, a hot one is salted."""
    totals = coded.groupBy("own_label").agg(F.sum("error").alias("label_error")).withColumnRenamed("own_label", "same_label").checkpoint()
    small = broadcast_if_small(totals, limit)
    same = F.col("own_label").eqNullSafe(F.col("same_label"))
    if small is not totals:
        return coded.join(small, same).drop("same_label")
    spread = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = coded.withColumn("own_salt", F.pmod(F.xxhash64(salt_key), F.lit(SALTS)).cast("int"))
    return salted.join(spread, same & (F.col("own_salt") == F.col("salt"))).drop("same_label", "own_salt", "salt")


def compress_vectors(
    vectors: DataFrame,
    *,
    scale: int = SCALE,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows (id, code, error, label_error, codebooks_sha256), one for each complete vector.

    Vectors that are null or hold null, non-finite or over-large (LARGEST) components are
    left out. All others of the first one's length train the codebooks and get a code; those of
    another length, or all if that is no multiple of ``parts`` or no vector has an id, have
    null code and error. ``label_error`` sums the errors of equal labels, nulls together.

    Repeated rows count as often as they occur, rows without id are coded like others, an
    empty table gives an empty result, and further columns are not looked at.
    """
    spark = vectors.sparkSession
    enable_checkpoints(spark)
    given = vectors.select(F.col(id_col).alias("own_id"), F.col(vector_col).alias("own_vector"), F.col(label_col).alias("own_label"))
    kept = integer_vectors(given, "own_vector", scale)
    codebooks = train_codebooks(kept, parts=parts, entries=entries, rounds=rounds, id_col="own_id", vector_col="own_vector")
    path = scratch_path(spark, "vector-codes")
    encode_vectors(kept, codebooks, id_col="own_id", vector_col="own_vector", label_col="own_label").write.parquet(path)
    whole = _with_label_error(spark.read.parquet(path), F.struct("own_id", "code"), broadcast_bytes)
    digest = F.lit(codebooks_digest(codebooks))
    return whole.select(F.col("own_id").alias(id_col), "code", "error", "label_error", digest.alias("codebooks_sha256"))
