"""Token counts by a two-tier lookup inside the tasks; no pre-token is ever shuffled.

A SentencePiece vocabulary whose pieces hold a word separator at their beginning only
never joins across the start of a run of spaces. A text is thus a chain of pre-tokens
(spaces, then other characters) whose token counts add up. The counts of the most
frequent pre-tokens are broadcast as two sorted arrays; those of all others come from
the library once and stay in a bounded cache of the worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.words import AS_IS, SPACE_ONLY, Words, mix, text_slices, word_slices

TABLE_SIZE = 16384  # pre-tokens in the broadcast table: 16384 * 12 bytes
TASK_SUMMARY = 4096  # pre-tokens that each task proposes for it
LONGEST = 64  # bytes and spaces of a pre-token in the summaries; longer ones are left to the caches
CACHE_SIZE = 400_000  # pre-tokens in a worker's cache; it starts anew when full

_SEPARATOR = "▁"  # SentencePiece's own sign for a space; in a text it counts as one


def _library(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def check_separable(model: bytes) -> None:
    """Refuse a vocabulary in which counts of pre-tokens do not add up."""
    library = _library(model)
    for i in range(library.get_piece_size()):
        if _SEPARATOR in library.id_to_piece(i).lstrip(_SEPARATOR):
            raise ValueError(f"piece {i} has a word separator inside")
    if library.encode("a  b", out_type=str) != library.encode("a", out_type=str) + library.encode(" b", out_type=str):
        raise ValueError("the vocabulary's normalizer changes white space")


def plain_spaces(column: pa.Array) -> pa.Array:
    return pc.replace_substring(column.fill_null(""), _SEPARATOR, " ")


def plain_slices(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """word_slices() at single spaces of the texts with plain spaces, of which one slice at a time is copied."""
    for low, high, _, _ in text_slices(column):
        # What is replaced gets shorter, so these texts are one slice again.
        for _, _, words in word_slices(plain_spaces(column.slice(low, high - low)), SPACE_ONLY, AS_IS):
            yield low, high, words


class PreTokens:
    """Pre-tokens of a slice of texts: words with the number of spaces before each."""

    def __init__(self, words):
        self.words, bounds = words, words.text_bounds
        before = np.concatenate(([0], words.end[:-1])) if len(words.start) else words.start
        opening = words.first[:-1][np.diff(words.first) > 0]
        before[opening] = bounds[:-1][np.diff(words.first) > 0]
        self.spaces = words.start - before
        self.spaces[opening] += 1  # the library puts one space before every text
        self.keys = words.hashes
        wide = self.spaces != 1
        self.keys[wide] = mix(self.keys[wide] + self.spaces[wide].astype(np.uint64))
        # Spaces at the end of a text are a pre-token of their own; alone they get the library's space too.
        last = bounds[:-1].copy()
        some = np.diff(words.first) > 0
        last[some] = words.end[words.first[1:][some] - 1]
        self.trailing = bounds[1:] - last
        self.trailing[(self.trailing > 0) & ~some] += 1

    def sizes(self) -> np.ndarray:
        return self.words.end - self.words.start + self.spaces

    def text(self, i: int) -> str:
        w = self.words
        return " " * (int(self.spaces[i]) - 1) + w.data[w.start[i] : w.end[i]].tobytes().decode()


def frequent_pre_tokens(texts: DataFrame, text_col: str) -> DataFrame:
    """(key, pre-token, times) of the commonest pre-tokens, by a bounded summary of every task.

    Counts are lower bounds, since a task forgets rare entries whenever its summary is
    full. Only speed depends on them. Pre-tokens of over ``LONGEST`` bytes are left out, so
    the driver gets TABLE_SIZE * LONGEST bytes at most.
    """

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, sample = np.zeros(0, np.uint64), np.zeros(0, np.int64), {}

        def cut(limit):
            nonlocal keys, times, sample
            if len(keys) > limit:
                top = np.sort(np.argpartition(times, -limit)[-limit:])
                keys, times = keys[top], times[top]
                sample = {k: sample[k] for k in keys.tolist()}

        for batch in batches:
            for _, _, words in word_slices(plain_spaces(batch.column(0)), SPACE_ONLY, AS_IS):
                found = PreTokens(words)
                new, first, counts = np.unique(found.keys, return_index=True, return_counts=True)
                often = (counts > 1) & (found.sizes()[first] <= LONGEST)
                new, first, counts = new[often], first[often], counts[often]
                for k, i in zip(new.tolist(), first.tolist()):
                    if k not in sample:
                        sample[k] = found.text(i)
                keys, inverse = np.unique(np.concatenate((keys, new)), return_inverse=True)
                times = np.bincount(inverse, np.concatenate((times, counts))).astype(np.int64)
                cut(16 * TASK_SUMMARY)
        cut(TASK_SUMMARY)
        yield pa.RecordBatch.from_pydict(
            {"key": keys.view(np.int64), "token": [sample[k] for k in keys.tolist()], "times": times},
            pa.schema([("key", pa.int64()), ("token", pa.string()), ("times", pa.int64())]),
        )

    proposed = texts.select(text_col).mapInArrow(summarise, "key long, token string, times long")
    return (
        proposed.groupBy("key")
        .agg(F.min("token").alias("token"), F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "key")
        .limit(TABLE_SIZE)
    )


_CACHES: dict[int, tuple] = {}  # of this worker process, by model


def _worker_state(model: bytes) -> tuple:
    name = hash(model)
    if name not in _CACHES:
        _CACHES.clear()
        _CACHES[name] = (_library(model), {})
    return _CACHES[name]


def _counts_of(found: PreTokens, keys, lengths, library, cache) -> np.ndarray:
    """Token count of every pre-token of a slice."""
    distinct, first, inverse = np.unique(found.keys, return_index=True, return_inverse=True)
    counts = np.zeros(len(distinct), np.int64)
    at = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
    known = keys[at] == distinct if len(keys) else np.zeros(len(distinct), bool)
    counts[known] = lengths[at[known]]
    rest = np.flatnonzero(~known)
    values = [cache.get(k) for k in distinct[rest].tolist()]
    missing = [i for i, v in enumerate(values) if v is None]
    if missing:
        texts = [found.text(first[rest[i]]) for i in missing]
        if len(cache) + len(missing) > CACHE_SIZE:
            cache.clear()
        for i, ids in zip(missing, library.encode(texts, num_threads=1)):
            values[i] = cache[int(distinct[rest[i]])] = len(ids)
    counts[rest] = values
    return counts[inverse]


def count_tokens(
    docs: DataFrame, model: bytes, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096
) -> DataFrame:
    """Rows (id, n_bytes, n_tokens, over_limit), one for each input row.

    ``model`` is the content of a SentencePiece file. Counts are those of the library
    without added tokens; strings that look like special tokens are ordinary text.

    A null or empty text has 0 bytes and 0 tokens. Null ids and repeated rows are kept
    as they are, other columns are not looked at, an empty table gives an empty result.
    Texts of any length are counted whole.
    """
    check_separable(model)
    spark = docs.sparkSession
    table = frequent_pre_tokens(docs, text_col).toPandas()  # at most TABLE_SIZE rows of LONGEST bytes
    keys = table["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    lengths = np.array([len(x) for x in _library(model).encode(table["token"].tolist())], np.int32)
    shared = spark.sparkContext.broadcast((model, keys[order], lengths[order] if len(order) else lengths))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, keys, lengths = shared.value
        library, cache = _worker_state(model)
        for batch in batches:
            texts = plain_spaces(batch.column(1))
            totals = np.zeros(batch.num_rows, np.int64)
            for low, high, words in word_slices(texts, SPACE_ONLY, AS_IS):
                found = PreTokens(words)
                counts = _counts_of(found, keys, lengths, library, cache)
                sums = np.concatenate(([0], np.cumsum(counts)))
                totals[low:high] = sums[words.first[1:]] - sums[words.first[:-1]]
                for i in np.flatnonzero(found.trailing):
                    n = int(found.trailing[i])
                    if n not in cache:
                        cache[n] = len(library.encode("a" + " " * n)) - len(library.encode("a"))
                    totals[low + i] += cache[n]
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(totals)], names=["doc_id", "n_bytes", "n_tokens"]
            )

    kind = dict(docs.dtypes)[id_col]
    counted = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("doc_id", id_col)
