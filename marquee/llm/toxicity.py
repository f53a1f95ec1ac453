"""Toxic spans by a linear-chain conditional random field over words.

Documents carry the only labels there are, so training words get theirs by distant
supervision: inside toxic documents, a word counts as toxic if one of its features (its
whole form or a prefix) stands in toxic documents significantly more often than in clean
ones, and next to never in these.
The chain (two states, one chain for each sentence) is trained on these words; forward
and backward passes then give the marginal of every word of every text. A document's
score is a calibrated function of its strongest marginal and of the expected number of
toxic words; words with a marginal of a half or more are its offending spans.

Chains do not depend on each other, so the fit goes through them in groups of about GROUP_WORDS
words: for a word of the whole sample it keeps its features and its label, about 20 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.labels import SAMPLE_BYTES, held_out, labelled_sample, logistic_fit, sigmoid
from marquee.llm.words import LOWER, give_back, mix, returning_memory, rolling_sums, span_hashes, split, text_slices

SAMPLE_PER_CLASS = 2048  # labelled documents of each class that the model is fitted on, at most
CELLS = 1 << 20
PREFIXES = (4, 5, 6)
TEMPLATES = 1 + len(PREFIXES)
LEAST_TEXTS, CLEAN_RATIO, FALSE_SHARE = 4, 30.0, 0.01
ROUNDS, RATE, RIDGE = 40, 0.5, 1e-5
GROUP_WORDS = 1 << 19  # words that the fit works on at a time, or one chain or text that has more

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_ENDS = np.zeros(256, bool)
_ENDS[[33, 46, 63]] = True  # the signs . ! ? end a sentence


@dataclass
class Tokens:
    """Words of a slice without outer punctuation: cells of their features, chains, bounds."""

    cells: np.ndarray  # (TEMPLATES, words)
    chain_start: np.ndarray
    chain_length: np.ndarray
    first: np.ndarray  # n + 1: the words of each text
    start: np.ndarray
    end: np.ndarray


def _trimmed(data, start, end):
    """Bounds without punctuation at either end; words of punctuation only keep theirs."""
    plain = np.flatnonzero(~_PUNCTUATION[data])
    first, after = np.searchsorted(plain, start), np.searchsorted(plain, end)
    some = after > first
    low, high = start.copy(), end.copy()
    low[some], high[some] = plain[first[some]], plain[after[some] - 1] + 1
    return low, high


def tokens(data: np.ndarray, bounds: np.ndarray) -> Tokens:
    words = split(data, bounds)
    start, end, n = words.start, words.end, len(words.start)
    if not n:
        return Tokens(np.zeros((TEMPLATES, 0), np.int32), start, start, words.first, start, end)
    low, high = _trimmed(data, start, end)
    sums = rolling_sums(data, LOWER)
    cells = np.empty((TEMPLATES, n), np.int32)
    cells[0] = span_hashes(sums, low, high) >> np.uint64(44)
    for k, size in enumerate(PREFIXES, 1):
        # A word shorter than the prefix has its whole form again, under another name.
        h = span_hashes(sums, low, np.minimum(low + size, high))
        cells[k] = mix(h + np.uint64(k)) >> np.uint64(44)
    opens = np.zeros(n, bool)
    opens[words.first[:-1][words.first[:-1] < n]] = True
    opens[1:] |= _ENDS[data[end[:-1] - 1]]
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    opens[1:] |= lines[start[1:]] > lines[end[:-1]]
    chain_start = np.flatnonzero(opens)
    return Tokens(cells, chain_start, np.diff(np.append(chain_start, n)), words.first, low, high)


def _joint(into_one, into_zero, message):
    """Log odds after one step: from state 1 with ``message`` as log odds, and from state 0."""
    return np.logaddexp(message + into_one[1], into_one[0]) - np.logaddexp(message + into_zero[1], into_zero[0])


def marginals(emission: np.ndarray, start: np.ndarray, length: np.ndarray, moves: np.ndarray):
    """Log odds of state 1 for every word, with the forward and backward log odds.

    ``emission`` is each word's score of state 1 over state 0, ``moves[i, j]`` the score of
    state i followed by j. All chains advance together, the longest first; a step handles
    the chains that still have a word.
    """
    forward, backward = emission.astype(float), np.zeros(len(emission))
    order = np.argsort(-length, kind="stable")
    begin, size = start[order], length[order]
    alive = len(size) - np.searchsorted(size[::-1], np.arange(1, (size[0] if len(size) else 0) + 1))
    for t in range(1, len(alive)):
        at = begin[: alive[t]] + t
        forward[at] += _joint((moves[0, 1], moves[1, 1]), (moves[0, 0], moves[1, 0]), forward[at - 1])
    for t in range(len(alive) - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        later = emission[at + 1] + backward[at + 1]
        backward[at] = _joint((moves[1, 0], moves[1, 1]), (moves[0, 0], moves[0, 1]), later)
    return forward + backward, forward, backward


def _groups(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(low, high) of consecutive parts that have ``limit`` words together, or of one that has more.

    Part i has the words from bounds[i] to bounds[i + 1].
    """
    low = 0
    while low < len(bounds) - 1:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1)
        yield low, high
        low = high


def _distinct_texts(cells: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of each document's text, near copies having the same: documents with an equal minimum of shingle hashes."""
    same = np.arange(len(first) - 1)
    long = np.flatnonzero(np.diff(first) >= 5)
    minima = np.empty((8, len(long)), np.uint64)
    for low, high in _groups(first, GROUP_WORDS):
        h = cells[0, first[low] : first[high]].astype(np.uint64)
        runs = np.zeros(len(h), np.uint64)
        for k in range(5):
            runs = mix(runs + np.roll(h, -k) + np.uint64(1))
        a, b = np.searchsorted(long, (low, high))
        begin, end = first[long[a:b]] - first[low], first[long[a:b] + 1] - first[low]
        for seed in range(8):
            own = mix(runs ^ np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % (1 << 64)))
            minima[seed, a:b] = [own[x : y - 4].min() for x, y in zip(begin, end)]
    for least in minima:
        place = np.unique(least, return_inverse=True)[1]
        while True:  # the smallest number spreads over documents of equal minimum and of equal number
            before = same.copy()
            smallest = np.full(len(long), len(same))
            np.minimum.at(smallest, place, same[long])
            target = np.arange(len(same))
            np.minimum.at(target, same[long], smallest[place])
            same = target[same]
            if (same == before).all():
                break
    return same


def _texts_by_cell(cells: np.ndarray, text: np.ndarray) -> np.ndarray:
    """How many distinct texts hold each cell."""
    pairs = cells.astype(np.int64)
    pairs <<= 32
    pairs |= text
    pairs.sort()
    fresh = np.ones(len(pairs), bool)
    fresh[1:] = pairs[1:] != pairs[:-1]
    pairs = pairs[fresh]
    pairs >>= 32
    return np.bincount(pairs, minlength=CELLS)


def _toxic_words(cells: np.ndarray, toxic_doc: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Distant labels of training words, given whether their document is toxic and the number of its text.

    Evidence are distinct texts, so a form that near copies repeat counts once. A form
    must be so unevenly spread over toxic and clean texts that of all forms found
    FALSE_SHARE at most are expected by chance (Benjamini-Hochberg over tail bounds).
    """
    marked = np.zeros(cells.shape[1], bool)
    n_toxic, n_clean = max(toxic_doc.sum(), 1), max((~toxic_doc).sum(), 1)
    for k in range(TEMPLATES):
        texts = [_texts_by_cell(cells[k, own], text[own]) for own in (toxic_doc, ~toxic_doc)]
        seen = np.flatnonzero(texts[0] + texts[1])
        t, c = texts[0][seen], texts[1][seen]
        chance, share = max(t.sum(), 1) / max((t + c).sum(), 1), t / (t + c)
        # Chernoff bound of the chance that so many of a form's texts are toxic.
        with np.errstate(divide="ignore", invalid="ignore"):
            apart = np.where(t > 0, share * np.log(share / chance), 0)
            apart += np.where(c > 0, (1 - share) * np.log((1 - share) / (1 - chance)), 0)
        p = np.where(share > chance, np.exp(-(t + c) * apart), 1.0)
        order = np.argsort(p)
        passed = np.flatnonzero(p[order] <= FALSE_SHARE * np.arange(1, len(p) + 1) / max(len(p), 1))
        bound = p[order[passed[-1]]] if len(passed) else -1.0
        significant = np.zeros(CELLS, bool)
        significant[seen[(p <= bound) & (t >= LEAST_TEXTS)]] = True
        toxic = np.bincount(cells[k, toxic_doc], minlength=CELLS)
        clean = np.bincount(cells[k, ~toxic_doc], minlength=CELLS)
        pure = significant & (toxic / n_toxic >= CLEAN_RATIO * clean / n_clean)
        marked |= pure[cells[k]]
    return marked & toxic_doc


def emissions(theta: np.ndarray, cells: np.ndarray, bias: float) -> np.ndarray:
    total = np.full(cells.shape[1], bias)
    for own in cells:
        total += theta[own]
    return total


def _expected_moves(emission, forward, backward, start, moves):
    """Expected number of moves between neighbours: each is forward, move, emission and backward."""
    inner = np.ones(len(emission), bool)
    inner[start] = False
    later = np.flatnonzero(inner)
    f, b = forward[later - 1], emission[later] + backward[later]
    whole = np.logaddexp(np.logaddexp(moves[0, 0], moves[0, 1] + b), f + np.logaddexp(moves[1, 0], moves[1, 1] + b))
    return np.array([[np.exp(moves[i, j] + i * f + j * b - whole).sum() for j in (0, 1)] for i in (0, 1)])


def fit_chain(cells: np.ndarray, start: np.ndarray, length: np.ndarray, y: np.ndarray):
    """Feature weights and transition scores that maximise the regularised likelihood of the word labels.

    The chains follow each other without gaps.
    """
    theta, moves = np.zeros(CELLS), np.zeros((2, 2))
    count = sum(np.bincount(own, minlength=CELLS) for own in cells)
    scale = 1 / np.sqrt(np.maximum(count, 1))
    del count
    square, square_moves = np.full(CELLS, 1e-6), np.full((2, 2), 1e-6)
    n = max(len(y), 1)
    bounds = np.append(start, len(y))
    groups = [(low, high, slice(bounds[low], bounds[high])) for low, high in _groups(bounds, GROUP_WORDS)]
    seen = np.zeros((2, 2))
    for low, high, part in groups:
        inner = np.ones(part.stop - part.start, bool)
        inner[start[low:high] - part.start] = False
        move = 2 * y[part].astype(np.int8)[:-1] + y[part][1:]
        seen += np.bincount(move[inner[1:]], minlength=4).reshape(2, 2)
    bias = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)) if len(y) else 0.0
    gradients = np.empty((len(cells), CELLS))
    for _ in range(ROUNDS):
        gradients[:] = 0
        joint = np.zeros((2, 2))
        for low, high, part in groups:
            own_start = start[low:high] - part.start
            emission = emissions(theta, cells[:, part], bias)
            odds, forward, backward = marginals(emission, own_start, length[low:high], moves)
            joint += _expected_moves(emission, forward, backward, own_start, moves)
            del emission, forward, backward
            error = sigmoid(odds) - y[part]
            for total, own in zip(gradients, cells[:, part]):
                total += np.bincount(own, error, CELLS)
        gradient = sum(gradients) * scale + RIDGE * n * theta * 1e-2
        gradient_moves = (joint - seen) / np.sqrt(n) + 0.01 * moves
        square += gradient**2
        square_moves += gradient_moves**2
        theta -= RATE * gradient / np.sqrt(square)
        moves -= 0.2 * gradient_moves / np.sqrt(square_moves)
    return theta, moves, bias


def _summary(odds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(strongest log odds, logarithm of the expected number) of each text.

    Words with a marginal below a tenth add nothing, so that length alone is no offence.
    """
    p = sigmoid(odds)
    p = np.concatenate(([0], np.cumsum(np.where(p >= 0.1, p, 0))))
    expected = np.log1p(np.maximum(p[first[1:]] - p[first[:-1]], 0))
    strongest = np.full(len(first) - 1, -6.0)
    some = np.diff(first) > 0
    if some.any():
        strongest[some] = np.maximum.reduceat(odds, first[:-1][some])
    return np.column_stack((np.clip(strongest, -6, 6), expected))


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, bounds in text_slices(batch.column(0)):
            t = tokens(data, bounds)
            opens = np.zeros(len(t.start), np.int32)
            opens[t.chain_start] = 1
            rows = np.column_stack((*t.cells, opens))
            parts = [rows[a:b].tobytes() for a, b in zip(t.first[:-1], t.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.binary()), batch.column(1).slice(low, high - low)], names=["rows", "label"]
            )


@dataclass
class ToxicityModel:
    """``constant`` alone where no chain could be fitted."""

    theta: np.ndarray | None = None
    moves: np.ndarray | None = None
    bias: float = 0.0
    calibration: np.ndarray | None = None
    constant: float = 0.5

    def score(self, odds: np.ndarray, first: np.ndarray) -> np.ndarray:
        return sigmoid(_summary(odds, first) @ self.calibration[:2] + self.calibration[2])

    def odds(self, t: Tokens) -> np.ndarray:
        return marginals(emissions(self.theta, t.cells, self.bias), t.chain_start, t.chain_length, self.moves)[0]


def fit_documents(rows: list[np.ndarray], labels: np.ndarray, class_sizes: tuple[int, int]) -> ToxicityModel:
    first = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
    cells, opens = np.empty((TEMPLATES, first[-1]), np.int32), np.empty(first[-1], bool)
    for own, low, high in zip(rows, first[:-1], first[1:]):
        cells[:, low:high], opens[low:high] = own[:, :TEMPLATES].T, own[:, TEMPLATES]
    start = np.flatnonzero(opens)
    length = np.diff(np.append(start, len(opens)))
    del opens
    text = _distinct_texts(cells, first).astype(np.int32)
    y = _toxic_words(cells, *(np.repeat(x, np.diff(first)) for x in (labels == 1, text)))
    theta, moves, bias = fit_chain(cells, start, length, y)
    theta = theta.astype(np.float32)
    summary = np.empty((len(rows), 2))
    for low, high in _groups(first, GROUP_WORDS):
        a, b = np.searchsorted(start, (first[low], first[high]))
        emission = emissions(theta, cells[:, first[low] : first[high]], bias)
        odds = marginals(emission, start[a:b] - first[low], length[a:b], moves)[0]
        summary[low:high] = _summary(odds, first[low : high + 1] - first[low])
    weight = np.where(labels == 1, class_sizes[1] / (labels == 1).sum(), class_sizes[0] / (labels == 0).sum())
    return ToxicityModel(theta, moves, bias, logistic_fit(summary, labels.astype(float), weight))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "toxic", id_col: str = "doc_id",
    text_col: str = "text", sample_per_class: int = SAMPLE_PER_CLASS, sample_bytes: int = SAMPLE_BYTES,
) -> ToxicityModel:
    """Fit in one task on a sample of labelled documents, bounded in documents and bytes.

    A constant where only one class or none is labelled. Nulls, repeated ids and empty
    tables as in labelled_sample().
    """
    sample, sizes = labelled_sample(docs, labels, label_col, sample_per_class, id_col, text_col, sample_bytes)
    prior = ToxicityModel(constant=(sizes[1] + 1) / (sum(sizes) + 2))
    if min(sizes) == 0:
        return prior

    def fit(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, [("label", "ascending"), ("rows", "ascending")]).to_pylist()
        y = table["label"].to_numpy()[order]
        theta, rest = [], []
        if len(set(y)) == 2:
            # Views of the table's own bytes.
            rows = [np.frombuffer(table["rows"][i].as_buffer(), np.int32).reshape(-1, TEMPLATES + 1) for i in order]
            m = fit_documents(rows, y, sizes)
            del rows
            give_back()
            theta, rest = [m.theta.tobytes()], [np.concatenate((m.moves.ravel(), [m.bias], m.calibration)).tobytes()]
        return pa.table({"theta": pa.array(theta, pa.binary()), "rest": pa.array(rest, pa.binary())})

    tokenised = sample.mapInArrow(returning_memory(_tokenised), "rows binary, label int").withColumn("all", F.lit(True))
    found = tokenised.groupBy("all").applyInArrow(fit, "theta binary, rest binary").collect()
    if not found:
        return prior
    rest = np.frombuffer(found[0].rest)
    return ToxicityModel(np.frombuffer(found[0].theta, np.float32), rest[:4].reshape(2, 2), rest[4], rest[5:])


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Rows (id, held_out, score, predicted, n_spans, spans), one for each input row.

    ``spans`` lists the offending words as start:end in code points, end exclusive, joined
    by commas. A null or empty text has no word and no span and gets the score of a text
    without toxic words. Null ids and repeated rows are kept; other columns are not looked
    at. Texts are used whole, however long.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # CELLS numbers and a few

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, spans = np.full(batch.num_rows, model.constant), np.full(batch.num_rows, "", object)
            counts = np.zeros(batch.num_rows, np.int64)
            if model.theta is not None:
                for low, high, data, bounds in text_slices(batch.column(1)):
                    t = tokens(data, bounds)
                    odds = model.odds(t)
                    scores[low:high] = model.score(odds, t.first)
                    hit = np.flatnonzero(odds >= 0)
                    if len(hit):
                        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                        text = np.searchsorted(t.first, hit, "right") - 1
                        counts[low:high] = np.bincount(text, minlength=high - low)
                        base = points[bounds[text]]
                        named = [f"{a}:{b}" for a, b in zip(points[t.start[hit]] - base, points[t.end[hit]] - base)]
                        begin = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
                        for a, b in zip(begin, np.append(begin[1:], len(text))):
                            spans[low + text[a]] = ",".join(named[a:b])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(counts), pa.array(spans, pa.string())],
                names=["doc_id", "score", "n_spans", "spans"],
            )

    kind = dict(docs.dtypes)[id_col]
    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        score, f"doc_id {kind}, score double, n_spans long, spans string"
    )
    return scored.select(
        F.col("doc_id").alias(id_col),
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_spans",
        "spans",
    )


def drop_toxic(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score is below the threshold, with all columns as they are; nothing is shuffled.

    A null or empty text has no toxic word, so its row stays unless the model is a constant
    over the threshold. Each of repeated rows is judged alike; other columns may have any
    names and null values; an empty table gives an empty one. Texts are used whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = np.full(batch.num_rows, model.constant)
            if model.theta is not None:
                for low, high, data, bounds in text_slices(batch.column(place)):
                    t = tokens(data, bounds)
                    scores[low:high] = model.score(model.odds(t), t.first)
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(returning_memory(keep), docs.schema)
