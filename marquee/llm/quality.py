"""Quality classifier: naive Bayes log-count ratios as feature scales of a linear hinge-loss model.

Features are indicators of byte n-grams (1 to 4 bytes) and of runs of the same word (2 to
5 times in a row), the n-grams hashed to a fixed number of cells. An indicator is scaled by the
logarithm of its smoothed class-count ratio; a support vector machine is then fitted to
the scaled, length-normalised rows by dual coordinate descent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.labels import SAMPLE_BYTES, held_out, labelled_sample, logistic_fit, sigmoid
from marquee.llm.words import split, text_slices

SAMPLE_PER_CLASS = 4096  # labelled documents of each class that the model is fitted on, at most
CELLS = 1 << 18
NGRAMS = (1, 2, 3, 4)
RUNS = (2, 3, 4, 5)
OWN_CELLS = 8  # the first cells are of repetitions alone
SMOOTHING, COST, EPOCHS, BLEND = 1.0, 1.0, 20, 0.25

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Indicators:
    """The distinct cells of each text of a slice."""

    def __init__(self):
        self.seen = np.zeros(CELLS, np.int32)

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        words = split(data, bounds)
        h = words.hashes
        same = np.zeros(len(h), np.int32)  # how often a word has just been repeated
        if len(h):
            equal = np.concatenate(([False], h[1:] == h[:-1]))
            equal[words.first[:-1][words.first[:-1] < len(h)]] = False
            position = np.arange(len(h))
            same = position - np.maximum.accumulate(np.where(equal, 0, position))
        grams, code = [], np.zeros(len(data), np.uint64)
        for n in NGRAMS:
            code = code[: len(data) - n + 1] * np.uint64(256) + data[n - 1 :]
            cells = (((code + np.uint64(n << 40)) * _ODD) >> np.uint64(46)).astype(np.int32)
            cells[cells < OWN_CELLS] += OWN_CELLS
            grams.append(cells)
        for i in range(len(bounds) - 1):
            low, high = bounds[i], bounds[i + 1]
            cells = np.concatenate([g[low : max(low, high - n + 1)] for n, g in zip(NGRAMS, grams)])
            longest = same[words.first[i] : words.first[i + 1]].max(initial=0) + 1
            cells = np.concatenate((cells, [r for r in RUNS if longest >= r])).astype(np.int32)
            order = np.arange(len(cells), dtype=np.int32)
            self.seen[cells] = order  # the last of equal cells wins
            yield cells[self.seen[cells] == order]


def _descend(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Weights per cell (last: the constant) of the hinge-loss model, by dual coordinate descent."""
    weights, values = np.zeros(CELLS + 1), []
    rows = [np.append(r, CELLS) for r in rows]
    for r in rows:
        v = np.append(scale[r[:-1]], 0)
        v /= max(np.sqrt(v @ v), 1e-12)
        v[-1] = 1
        values.append(v)
    square = np.array([v @ v for v in values])
    alpha, generator = np.zeros(len(rows)), np.random.default_rng(7)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in generator.permutation(len(rows)):
            r, v = rows[i], values[i]
            new = min(max(alpha[i] - (y[i] * (weights[r] @ v) - 1) / square[i], 0), COST)
            if new != alpha[i]:
                weights[r] += (new - alpha[i]) * y[i] * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    constant = weights[-1]
    weights = (1 - BLEND) * np.abs(weights[:-1]).mean() + BLEND * weights
    weights[-1] = BLEND * constant
    return weights


def _ratios(rows, y) -> np.ndarray:
    counts = [np.bincount(np.concatenate([r for r, t in zip(rows, y) if t == v]), minlength=CELLS) + SMOOTHING for v in (1, -1)]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def _margin(weights, scale, r) -> float:
    v = scale[r]
    return float(weights[r] @ v / max(np.sqrt(v @ v), 1e-12) + weights[-1])


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, class_sizes: tuple[int, int]) -> np.ndarray:
    """[scaled weights..., constant, calibration slope, calibration constant], with the scales first."""
    y = np.where(labels == 1, 1.0, -1.0)
    weight = np.where(labels == 1, class_sizes[1] / (labels == 1).sum(), class_sizes[0] / (labels == 0).sum())
    margins, half = np.zeros(len(y)), np.arange(len(y)) % 2
    for part in (0, 1):  # margins of rows that their model has not seen
        own = np.flatnonzero(half != part)
        if len(set(y[own])) < 2:
            own = np.arange(len(y))
        scale = _ratios([rows[i] for i in own], y[own])
        weights = _descend([rows[i] for i in own], y[own], scale)
        for i in np.flatnonzero(half == part):
            margins[i] = _margin(weights, scale, rows[i])
    slope, constant = logistic_fit(margins[:, None], (y > 0).astype(float), weight)
    scale = _ratios(rows, y)
    return np.concatenate((scale, _descend(rows, y, scale), [slope, constant])).astype(np.float32)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells_of = Indicators()
    for batch in batches:
        for low, high, data, bounds in text_slices(batch.column(0)):
            found = [c.tobytes() for c in cells_of(data, bounds)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch.column(1).slice(low, high - low)], names=["cells", "label"]
            )


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", sample_per_class: int = SAMPLE_PER_CLASS, sample_bytes: int = SAMPLE_BYTES,
) -> np.ndarray | float:
    """The fitted model, or a constant score where only one class or none is labelled.

    One task fits the sample, which is bounded in documents and bytes; nothing here grows
    with the input but the scan. Nulls, repeated ids and empty tables as in labelled_sample().
    """
    sample, sizes = labelled_sample(docs, labels, label_col, sample_per_class, id_col, text_col, sample_bytes)
    if min(sizes) == 0:
        return (sizes[1] + 1) / (sum(sizes) + 2)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["label", "cells"], key=lambda c: c if c.name == "label" else c.map(hash_bytes))
        cells = [np.frombuffer(c, np.int32) for c in rows["cells"]]
        y = rows["label"].to_numpy()
        model = fit_rows(cells, y, sizes) if len(set(y)) == 2 else np.array([(y.sum() + 1) / (len(y) + 2)], np.float32)
        return pd.DataFrame({"model": [model.tobytes()]})

    featured = sample.mapInArrow(_features, "cells binary, label int").withColumn("all", F.lit(True))
    found = featured.groupBy("all").applyInPandas(fit, "model binary").collect()
    if not found:  # labels of documents that are not there
        return (sizes[1] + 1) / (sum(sizes) + 2)
    model = np.frombuffer(found[0].model, np.float32)
    return float(model[0]) if len(model) == 1 else model


def hash_bytes(value: bytes) -> int:
    return int.from_bytes(value[:8], "little") ^ len(value) if value else 0


def score_quality(
    docs: DataFrame, model: np.ndarray | float, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """Rows (id, held_out, score, predicted), one for each input row.

    A null or empty text has no indicators and gets the score of the constant. Null ids
    and repeated rows are kept; other columns are not looked at. Texts are used whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 * CELLS + 3 numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cells_of = shared.value, Indicators()
        fixed = isinstance(model, float)
        if not fixed:
            scale, weights, (slope, constant) = model[:CELLS], model[CELLS : 2 * CELLS + 1], model[-2:]
            product, square = (weights[:-1] * scale).astype(float), (scale * scale).astype(float)
        for batch in batches:
            scores = np.full(batch.num_rows, model if fixed else 0.0)
            if not fixed:
                for low, _, data, bounds in text_slices(batch.column(1)):
                    for i, r in enumerate(cells_of(data, bounds)):
                        margin = product[r].sum() / max(np.sqrt(square[r].sum()), 1e-12) + weights[-1]
                        scores[low + i] = sigmoid(slope * margin + constant)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    kind = dict(docs.dtypes)[id_col]
    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        score, f"doc_id {kind}, score double"
    )
    return scored.select(
        F.col("doc_id").alias(id_col),
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
