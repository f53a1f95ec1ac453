"""Training rows for the document classifiers, and the held-out fifth of the documents."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import enable_checkpoints

FOLDS = 5
SAMPLE_BYTES = 32 << 20  # UTF-8 bytes of the sampled texts of each class, at most


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, bound: int, id_col: str, text_col: str, max_bytes: int = SAMPLE_BYTES
):
    """(text, label) of at most ``bound`` training documents of each class, and the size of each class.

    The sample is the rows of smallest hash of the id, so it is the same in every run. Its
    ids are broadcast (2 * bound rows at most), hence no text is shuffled but the sample's.
    Labels other than 0 and 1 are left out; a document labelled twice counts as 1 if any
    label is. Of a repeated id the text of smallest hash enters, and equal texts enter
    once. The texts of a class have ``max_bytes`` at most, in that order, unless the first
    has more by itself; a text is taken whole or not at all. A null text is empty, rows
    without id are left out, and without labels or documents the sample has no row.
    """
    enable_checkpoints(docs.sparkSession)
    usable = (
        labels.filter(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
        .groupBy(id_col)
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    )
    order = (F.xxhash64(id_col), F.col(id_col))
    parts = [usable.filter(F.col("label") == v).orderBy(*order).limit(bound) for v in (0, 1)]
    chosen = reduce(DataFrame.unionByName, parts).select(F.col(id_col).alias("sample_id"), "label")
    sample = (
        docs.select(F.col(id_col).alias("sample_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "sample_id")
        .withColumn("same", F.xxhash64("text"))
        .groupBy("sample_id")
        .agg(F.min(F.struct("same", "text", "label")).alias("row"))
        .groupBy("row.same")
        .agg(F.min(F.struct("sample_id", "row.label", "row.text")).alias("row"))
        .select("row.*")
        .checkpoint()
    )
    # Ids and lengths only: 2 * bound rows at most.
    before = Window.partitionBy("label").orderBy(F.xxhash64("sample_id"), "sample_id").rowsBetween(Window.unboundedPreceding, -1)
    size = F.octet_length("text").cast("long")
    running = sample.select("sample_id", "label", size.alias("size")).withColumn("before", F.sum("size").over(before))
    fitting = running.filter(F.col("before").isNull() | (F.col("before") + F.col("size") <= max_bytes)).select("sample_id")
    sizes = {row["label"]: row["n"] for row in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = sample.join(F.broadcast(fitting), "sample_id", "left_semi").select("text", "label")
    return sample, (sizes.get(0, 0), sizes.get(1, 0))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights of a small, slightly regularised logistic regression (last one: the constant), by Newton steps."""
    x = np.column_stack((x, np.ones(len(y))))
    beta = np.zeros(x.shape[1])
    ridge = np.full(len(beta), 1e-3) * weight.sum() / max(len(y), 1)
    loss = np.inf
    for _ in range(steps):
        p = sigmoid(x @ beta)
        gradient = x.T @ (weight * (p - y)) + ridge * beta
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(ridge)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-4:
            trial = beta - size * step
            z = x @ trial
            value = (weight * (np.logaddexp(0, z) - y * z)).sum() + (ridge * trial**2).sum() / 2
            if value <= loss:
                break
            size /= 2
        else:
            return beta
        if loss - value < 1e-9 * max(1, abs(value)):
            return trial
        beta, loss = trial, value
    return beta
