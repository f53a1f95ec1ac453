"""Benchmark decontamination by latent semantic retrieval.

The vocabulary is the benchmark's words. One pass over all documents counts the blocks of
``STRIDE`` words that hold each of them (inverse document frequencies); a second pass
multiplies the TF-IDF matrix A of all passages (two neighbouring blocks) as A'(A R) with a
random matrix R, which is the range finder of a randomised singular value decomposition;
the decomposition of that small product gives the latent directions. A third pass projects
every passage and every benchmark window and takes pairs of high cosine as candidates. A
candidate is a leak if the longest common subsequence of its words covers the window, or
covers part of it (a paraphrase) and the item's answer stands in the passage.

The benchmark is the stated query set: it is cut into parts of bounded size, and each
part is searched in all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.words import AS_IS, BLANKS, returning_memory, word_slices

PART_BYTES = 1 << 20  # benchmark text searched at a time; bounds vocabulary and broadcasts
WINDOW, STRIDE = 64, 32  # words of a passage and of its blocks
RANK, OVERSAMPLING = 224, 16
DENSE_SHARE = 0.02  # words in more blocks than this are multiplied as a dense matrix; results are the same
LEAST_COSINE = 0.3
COVERED, PARAPHRASED = 0.75, 0.5  # least share of a window's words in common order; the second needs the answer
ANSWER_WORDS = 5  # closing words of an item that stand for its answer where none is given
EIGHT, ROWS_AT_ONCE = 8, 4096  # rows of a run summed in step; rows of longer runs gathered at a time
SHORT = 8  # shorter windows must stand in the passage word by word

_U = np.uint64
# Letters in lower case, ASCII punctuation as blanks: a copy stays a leak in capitals or with other marks.
_GAPS = BLANKS.copy()
_GAPS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _plain_words(column: pa.Array):
    return word_slices(pc.utf8_lower(column), _GAPS, AS_IS)


@dataclass
class Benchmark:
    """A part of the benchmark: windows of word hashes, answers, and the vocabulary."""

    items: list  # item of each window
    windows: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: np.ndarray  # sorted
    flags: np.ndarray  # which leading 20 bits any vocabulary word has
    dense: np.ndarray  # places of the words that stand in many blocks

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of vocabulary words among the hashes, their places in the vocabulary)."""
        near = np.flatnonzero(self.flags[hashes >> _U(44)])
        place = np.minimum(np.searchsorted(self.vocabulary, hashes[near]), len(self.vocabulary) - 1)
        hit = self.vocabulary[place] == hashes[near]
        return near[hit], place[hit]


def _hashes(texts: list) -> list[np.ndarray]:
    result = []
    for _, _, words in _plain_words(pa.array(texts, pa.string())):
        h = words.hashes
        result += [h[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
    return result


def load_benchmark(rows: list[tuple]) -> Benchmark | None:
    """From (item, text, answer or None); items without words are left out, None if none is left."""
    items, windows, answers = [], [], []
    given = _hashes([answer for _, _, answer in rows])
    for (item, _, answer), words, own in zip(rows, _hashes([text for _, text, _ in rows]), given):
        if not len(words):
            continue
        answer = own if answer is not None and len(own) else words[-ANSWER_WORDS:]
        starts = range(0, max(len(words) - STRIDE, 1), STRIDE) if len(words) > WINDOW else [0]
        for s in starts:
            items.append(item)
            windows.append(words[s : s + WINDOW])
            answers.append(answer)
    if not windows:
        return None
    vocabulary = np.unique(np.concatenate(windows))
    flags = np.zeros(1 << 20, bool)
    flags[vocabulary >> _U(44)] = True
    return Benchmark(items, windows, answers, vocabulary, flags, np.zeros(0, np.int64))


def _blocks(words) -> tuple[np.ndarray, np.ndarray]:
    """(first block of each text and the end, text of each block) when words are cut by STRIDE."""
    per = -(-np.diff(words.first) // STRIDE)
    first = np.concatenate(([0], np.cumsum(per)))
    return first, np.repeat(np.arange(len(per)), per)


def _hits(bench: Benchmark, words):
    """(position, vocabulary place, block) of the vocabulary words of a slice, by position; number of blocks."""
    at, place = bench.places(words.hashes)
    first, text_of_block = _blocks(words)
    text = np.searchsorted(words.first, at, "right") - 1
    return at, place, first[text] + (at - words.first[text]) // STRIDE, first, text_of_block


def block_frequencies(texts: DataFrame, bench: Benchmark) -> tuple[np.ndarray, int]:
    """Number of blocks of all documents with each vocabulary word, and of all blocks."""
    shared = texts.sparkSession.sparkContext.broadcast(bench)
    n = len(bench.vocabulary)

    def count(batches):
        bench, total = shared.value, np.zeros(n + 1, np.int64)
        for batch in batches:
            for _, _, words in _plain_words(batch.column(0)):
                _, place, block, first, _ = _hits(bench, words)
                distinct = np.unique(block * np.int64(n) + place)
                total[:n] += np.bincount(distinct % n, minlength=n)
                total[n] += first[-1]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["place", "blocks"])

    counted = texts.mapInArrow(count, "place long, blocks long").groupBy("place").agg(F.sum("blocks").alias("blocks"))
    rows = counted.toPandas()  # one for each vocabulary word at most
    total = np.zeros(n + 1, np.int64)
    total[rows["place"]] = rows["blocks"]
    return total[:n], int(total[n])


def _run_sums(values: np.ndarray, rows: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place of each run of equal numbers in ``runs``, sum of values[rows] over it), longest runs first.

    The sums are those of np.add.reduceat to the last digit, which for up to EIGHT rows are the first
    plus the sum of the others in order. Such runs take their next row all at once, and longer ones
    go to it some thousand rows at a time, so values[rows] is never there as a whole.
    """
    begin = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
    length = np.diff(begin, append=len(runs))
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    longer = np.searchsorted(-length, -np.arange(EIGHT + 1))  # how many runs have more rows than 0, 1, ...
    sums = values[rows[begin]]
    end = np.cumsum(length[: longer[EIGHT]])
    low = 0
    while low < len(end):
        before = end[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(end, before + ROWS_AT_ONCE, "right")))
        first = np.concatenate(([0], end[low : high - 1] - before))
        at = np.arange(end[high - 1] - before) + np.repeat(begin[low:high] - first, length[low:high])
        sums[low:high] = np.add.reduceat(values[rows[at]], first)
        low = high
    short = begin[longer[EIGHT] : longer[1]]
    if len(short):
        others = values[rows[short + 1]]
        for k in range(2, EIGHT):
            own = short[: longer[k] - longer[EIGHT]]
            others[: len(own)] += values[rows[own + k]]
        sums[longer[EIGHT] : longer[1]] += others
    return begin, sums


class Hits:
    """The vocabulary words of a range of whole blocks as a matrix of counts, blocks by vocabulary.

    Frequent words are columns of a dense matrix, all others (block, place) in order of
    block; so the cost of a word follows the blocks, not its occurrences.
    """

    def __init__(self, bench: Benchmark, block: np.ndarray, place: np.ndarray, blocks: int):
        column = np.full(len(bench.vocabulary), -1)
        column[bench.dense] = np.arange(len(bench.dense))
        own = column[place]
        often = own >= 0
        width = len(bench.dense)
        counts = np.bincount(block[often] * width + own[often], minlength=blocks * width)
        self.counts = counts.reshape(blocks, width).astype(np.float32)
        self.dense, self.blocks = bench.dense, blocks
        self.block, self.place = block[~often], place[~often]

    def times(self, values: np.ndarray) -> np.ndarray:
        """counts @ values, of which there is one row for each vocabulary word."""
        sums = self.counts @ values[self.dense]
        if len(self.block):
            begin, more = _run_sums(values, self.place, self.block)
            sums[self.block[begin]] += more
        return sums

    def add_transposed(self, rows: np.ndarray, total: np.ndarray) -> None:
        """total += counts.T @ rows, of which there is one for each block."""
        total[self.dense] += self.counts.T @ rows
        if len(self.place):
            order = np.argsort(self.place, kind="stable")
            place = self.place[order]
            begin, more = _run_sums(rows, self.block[order], place)
            total[place[begin]] += more


def _pieces(bench: Benchmark, words, blocks: int = 1024) -> Iterator[tuple[int, int, int, Hits]]:
    """(first block, end, end with the block after, hits) of pieces of a slice; bounds the memory of products."""
    _, place, block, first, _ = _hits(bench, words)
    for low in range(0, int(first[-1]), blocks):
        high = min(low + blocks, int(first[-1]))
        end = min(high + 1, int(first[-1]))
        a, b = np.searchsorted(block, (low, end))
        yield low, high, end, Hits(bench, block[a:b] - low, place[a:b], end - low)


def _passages(sums: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Sums over passages from those of their blocks: passage p is blocks p and p + 1 of its text."""
    joined = sums.copy()
    inner = np.flatnonzero(text[1:] == text[:-1])
    joined[inner] += sums[inner + 1]
    return joined


def latent_directions(texts: DataFrame, bench: Benchmark, weight: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """(vocabulary, rank) right singular directions of the TF-IDF matrix of all passages.

    The benchmark's windows are rows of it too, scaled to half of its energy; else an item
    that few documents hold would have no direction of its own among frequent words.
    """
    n = len(weight)
    rank = min(RANK + OVERSAMPLING, n)
    random = np.random.default_rng(5).standard_normal((n, rank)).astype(np.float32)
    shared = texts.sparkSession.sparkContext.broadcast((bench, weight.astype(np.float32), random))

    def multiply(batches):
        bench, weight, random = shared.value
        scaled, product = random * weight[:, None], np.zeros((n, rank), np.float32)
        for batch in batches:
            for _, _, words in _plain_words(batch.column(0)):
                _, text_of_block = _blocks(words)
                before = np.zeros(rank, np.float32)  # the passage before a piece
                for low, high, end, hits in _pieces(bench, words):
                    text = text_of_block[low:end]
                    passages = _passages(hits.times(scaled), text)
                    # A word stands in the passage that begins with its block and in the one before.
                    gained = passages.copy()
                    inner = np.flatnonzero(text[1:] == text[:-1]) + 1
                    gained[inner] += passages[inner - 1]
                    if low and text_of_block[low - 1] == text[0]:
                        gained[0] += before
                    gained[high - low :] = 0  # the block after belongs to the next piece
                    before = passages[high - low - 1]
                    hits.add_transposed(gained, product)
        product *= weight[:, None]
        rows = np.flatnonzero(product.any(1))
        step = 512  # rows go in pieces, so that no piece of the sum is large
        for low in range(0, n, step):
            own = rows[(rows >= low) & (rows < low + step)]
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([low]), pa.array([own.tobytes()], pa.binary()), pa.array([product[own].tobytes()], pa.binary())],
                    names=["low", "rows", "sums"],
                )

    def add(table: pa.Table) -> pa.Table:
        total, low = np.zeros((512, rank)), table["low"][0].as_py()
        for own, sums in zip(table["rows"].to_pylist(), table["sums"].to_pylist()):
            own = np.frombuffer(own, np.int64)
            total[own - low] += np.frombuffer(sums, np.float32).reshape(len(own), rank)
        return pa.table({"low": [low], "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    parts = texts.mapInArrow(multiply, "low long, rows binary, sums binary").groupBy("low").applyInArrow(add, "low long, sums binary")
    product = np.zeros((-(-n // 512) * 512, rank))
    for row in parts.collect():  # vocabulary times rank numbers: PART_BYTES of benchmark bound them
        product[row.low : row.low + 512] = np.frombuffer(row.sums, np.float32).reshape(512, rank)
    places = [np.searchsorted(bench.vocabulary, own) for own in bench.windows]
    energy = 2 * (frequency * weight**2).sum()  # a word of a block stands in two passages
    scale = max(energy, 1) / sum((np.bincount(p, minlength=n)[p] * weight[p] ** 2).sum() for p in places)
    for p in places:
        np.add.at(product, p, scale * weight[p, None] * (weight[p] @ random[p])[None, :])
    left, _, _ = np.linalg.svd(product[:n], full_matrices=False)
    return np.ascontiguousarray(left[:, : min(RANK, rank)])


def common_subsequences(regions: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each row of regions with the window."""
    best = np.zeros((len(regions), regions.shape[1] + 1), np.int16)
    for word in window:
        taken = np.maximum(best[:, 1:], best[:, :-1] + (regions == word))
        best[:, 1:] = np.maximum.accumulate(taken, axis=1)
    return best[:, -1].astype(np.int64)


def _contains(regions: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Whether each row of regions holds the run of words without a gap."""
    width = regions.shape[1] - len(run) + 1
    found = np.zeros(len(regions), bool)
    if width > 0 and len(run):
        same = np.ones((len(regions), width), bool)
        for k, word in enumerate(run):
            same &= regions[:, k : k + width] == word
        found = same.any(1)
    return found


def _leaks(bench, weight, directions, latent, words, cosine_floor):
    """(text, window, covered share, cosine, answer found) of the leaks in a slice of texts."""
    hashes = words.hashes
    at, place = bench.places(hashes)
    places = np.full(len(hashes), -1)
    places[at] = place
    first, text_of_block = _blocks(words)
    weighed = directions * weight[:, None]
    passage, window, cosine = [], [], []
    for low, high, end, hits in _pieces(bench, words):
        projected = _passages(hits.times(weighed), text_of_block[low:end])[: high - low]
        norm = np.sqrt((projected * projected).sum(1))
        live = np.flatnonzero(norm > 0)
        c = (projected[live] / norm[live][:, None]) @ latent.T
        p, w = np.nonzero(c >= cosine_floor)
        passage.append(low + live[p])
        window.append(w)
        cosine.append(c[p, w])
    if not sum(map(len, passage)):
        return
    passage, window, cosine = map(np.concatenate, (passage, window, cosine))
    # The region is the passage and half a window on either side, inside its text.
    text = text_of_block[passage]
    start = words.first[text] + (passage - first[text]) * STRIDE - STRIDE
    reach = np.arange(WINDOW + 2 * STRIDE)
    order = np.argsort(window, kind="stable")
    begin = np.flatnonzero(np.concatenate(([True], np.diff(window[order]) != 0)))
    local = np.zeros(len(bench.vocabulary) + 1, np.int64)
    for rows in np.split(order, begin[1:]):
        w = window[rows[0]]
        own, answer = bench.windows[w], bench.answers[w]
        distinct, times = np.unique(own, return_counts=True)
        mine = np.searchsorted(bench.vocabulary, distinct)
        local[mine] = np.arange(1, len(mine) + 1)
        least = len(own) if len(own) < SHORT else PARAPHRASED * len(own)
        for low in range(0, len(rows), 2048):
            part = rows[low : low + 2048]
            at = start[part, None] + reach
            inside = (at >= words.first[text[part], None]) & (at < words.first[text[part] + 1, None])
            # No common order is longer than the words in common, however they stand.
            common = np.where(inside, local[places[np.clip(at, 0, len(hashes) - 1)]], 0)
            counts = np.bincount((np.arange(len(part))[:, None] * (len(mine) + 1) + common).ravel(), minlength=len(part) * (len(mine) + 1))
            may = np.minimum(counts.reshape(len(part), -1)[:, 1:], times).sum(1) >= least
            if not may.any():
                continue
            part, at, inside = part[may], at[may], inside[may]
            region = np.where(inside, hashes[np.clip(at, 0, len(hashes) - 1)], _U(0))
            share = common_subsequences(region, own) / len(own)
            if len(own) < SHORT:
                leaked = answered = _contains(region, own)
            else:
                answered = _contains(region, answer)
                leaked = (share >= COVERED) | ((share >= PARAPHRASED) & answered)
            for i in np.flatnonzero(leaked):
                yield int(text[part[i]]), int(w), float(share[i]), float(cosine[part[i]]), bool(answered[i])
        local[mine] = 0


def _prepared(texts: DataFrame, rows: list[tuple]):
    """Broadcast (benchmark, weights, directions, latent windows) for the search of a benchmark part, None without words."""
    bench = load_benchmark(rows)
    if bench is None:
        return None
    frequency, total = block_frequencies(texts, bench)
    weight = np.log((total + 1) / (frequency + 1)) + 1e-3
    bench.dense = np.flatnonzero(frequency > DENSE_SHARE * max(total, 1))
    directions = latent_directions(texts, bench, weight, frequency)
    latent = np.zeros((len(bench.windows), directions.shape[1]))
    for k, own in enumerate(bench.windows):
        place = np.searchsorted(bench.vocabulary, own)
        latent[k] = weight[place] @ directions[place]
    size = np.sqrt((latent * latent).sum(1, keepdims=True))
    # Directions come from the documents; a window that none of them touches is in no document.
    latent = (latent / np.where(size > 0, size, 1)).astype(np.float32)
    return texts.sparkSession.sparkContext.broadcast(
        (bench, weight.astype(np.float32), directions.astype(np.float32), latent)
    )


def _search(docs: DataFrame, shared, item_kind: str) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench, weight, directions, latent = shared.value
        for batch in batches:
            found = []
            for low, _, words in _plain_words(batch.column(1)):
                for text, window, share, cosine, answered in _leaks(bench, weight, directions, latent, words, LEAST_COSINE):
                    found.append((low + text, window, share, cosine, answered))
            at = [f[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(at, pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    *(pa.array([f[k] for f in found], pa.float64()) for k in (2, 3)),
                    pa.array([f[4] for f in found], pa.bool_()),
                ],
                names=["doc_id", "row", "window", "share", "cosine", "answered"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    found = docs.mapInArrow(search, f"doc_id {kind}, row long, window long, share double, cosine double, answered boolean")
    windows = docs.sparkSession.createDataFrame(list(enumerate(shared.value[0].items)), f"window long, item_id {item_kind}")
    return found.join(F.broadcast(windows), "window")  # windows of PART_BYTES of text


def _parts(
    texts: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, answer_col: str | None
) -> tuple[list, str]:
    """What _prepared() gives for each part of the benchmark that has words, and the type of item ids."""
    answer = F.col(answer_col) if answer_col else F.lit(None).cast("string")
    items = benchmark.select(
        F.col(item_col).alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"), answer.alias("answer")
    ).dropDuplicates()
    size = items.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("answer"), F.lit(0)))).first()[0] or 0
    parts = -(-size // PART_BYTES) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    prepared = []
    for k in range(parts):
        rows = [tuple(r) for r in items.filter(part == k).orderBy("item_id", "text", "answer").collect()]
        prepared.append(_prepared(texts, rows))
    return [shared for shared in prepared if shared is not None], dict(items.dtypes)["item_id"]


def leaked_passages(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None,
) -> DataFrame:
    """Rows (id, item, share, cosine, answered), one for each document and item leaked into it.

    ``share`` is the largest part of a window of the item's words that the document has in
    the same order, ``cosine`` the largest latent one, ``answered`` whether the answer
    (``answer_col``, or the item's closing words) stands at a leak.

    Items without words match nothing; items of fewer than SHORT words match only word by
    word. Items longer than a window match by any of their windows. Null or empty documents
    have no leaks, copies each have their own, rows with equal ids are reported once, null
    ids as one. Other columns are not looked at, and empty tables give an empty result.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prepared, item_kind = _parts(own.select("text"), benchmark, item_col, item_text_col, answer_col)
    found = [_search(own, shared, item_kind) for shared in prepared]
    if not found:
        kind = dict(own.dtypes)["doc_id"]
        return docs.sparkSession.createDataFrame(
            [], f"{id_col} {kind}, {item_col} {item_kind}, share double, cosine double, answered boolean"
        )
    return (
        reduce(DataFrame.unionByName, found)
        .groupBy("doc_id", "item_id")
        .agg(F.max("share").alias("share"), F.max("cosine").alias("cosine"), F.max("answered").alias("answered"))
        .withColumnsRenamed({"doc_id": id_col, "item_id": item_col})
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", answer_col: str | None = None, id_col: str = "doc_id",
) -> DataFrame:
    """The rows whose text holds no leak, all columns kept.

    Every row is judged by its own text in the pass that finds the leaks, so ids do not
    matter: they may be null or repeated, and ``id_col`` is not looked at. Nothing is
    shuffled or joined.
    """
    width = len(docs.columns)
    kept = docs.select("*", F.col(text_col)) if text_col not in docs.columns else docs
    place = width if text_col not in docs.columns else docs.columns.index(text_col)
    prepared, _ = _parts(docs.select(F.col(text_col).alias("text")), benchmark, item_col, item_text_col, answer_col)
    if not prepared:
        return docs

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for shared in prepared:
                bench, weight, directions, latent = shared.value
                for low, _, words in _plain_words(batch.column(place)):
                    for text, *_ in _leaks(bench, weight, directions, latent, words, LEAST_COSINE):
                        clean[low + text] = False
            yield batch.select(range(width)).filter(pa.array(clean))

    return kept.mapInArrow(returning_memory(keep), docs.schema)
