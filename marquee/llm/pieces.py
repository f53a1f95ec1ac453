"""SentencePiece encoding and decoding in numpy, many words at a time.

Words of equal length advance together. Their substrings are hashed and probed in the
sorted hashes of the vocabulary's pieces, which gives each batch a table of pieces by
start and length. From this table

* ``best_paths`` (vocabularies of type unigram) takes the path of highest total score by
  Viterbi's recursion, with vectorised maxima and stored backpointers;
* ``best_merges`` (type BPE) joins the best-scored neighbouring pair of every word, the
  leftmost of equal ones, until no pair is a piece. The library's result for such a
  vocabulary is defined by merges, and the path of highest score differs from it.

Words of over ``LONG_WORD`` characters are encoded one by one, by the same recursions over the
pieces themselves: merges from a heap of neighbouring pairs, paths by a loop over the
positions. Time and memory grow with their length (times its logarithm for merges).

Characters without a piece become byte pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.token_counts import PreTokens, check_separable, plain_slices
from marquee.llm.words import Words, mix, returning_memory

CACHE_TOKENS = 2_500_000  # ids in a worker's cache of encoded words; it starts anew when full
BATCH_CELLS = 500_000  # entries of one batch's piece table
LONG_WORD = 256  # characters from which a word is no longer part of a batch
UNKNOWN_SCORE = -1e4

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SEPARATOR = "▁"


class Vocabulary:
    """Pieces by hash; kinds and bytes of all ids."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = library.get_piece_size()
        text = [library.id_to_piece(i) for i in range(n)]
        special = np.array([library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(n)])
        is_byte = np.array([library.is_byte(i) for i in range(n)])
        score = np.array([library.get_score(i) for i in range(n)])
        usable = np.flatnonzero(~special & ~is_byte)
        self.longest = max(len(text[i]) for i in usable)
        hashes, length = np.zeros(len(usable), np.uint64), np.array([len(text[i]) for i in usable])
        for m in np.unique(length):
            same = np.flatnonzero(length == m)
            symbols = np.array([[ord(c) for c in text[usable[k]]] for k in same], np.uint64)
            hashes[same] = substring_hashes(symbols, m)[-1][:, 0]
        order = np.argsort(hashes)
        self.hashes, self.ids, self.scores = hashes[order], usable[order], score[usable[order]]
        self.id_of = {text[i]: int(i) for i in usable}
        self.score_of = {text[i]: float(score[i]) for i in usable}
        # Place of each piece in the order of merges; pieces of equal score share it.
        self.rank_of = dict(zip((text[i] for i in usable), np.unique(-score[usable], return_inverse=True)[1].tolist()))
        self.byte_ids = np.full(256, library.unk_id())
        for i in np.flatnonzero(is_byte):
            self.byte_ids[int(text[i][3:5], 16)] = i
        # What each id decodes to, in one pool.
        raw = [
            bytes([int(t[3:5], 16)]) if b else b"" if s else t.replace(_SEPARATOR, " ").encode()
            for t, b, s in zip(text, is_byte, special)
        ]
        self.pool = np.frombuffer(b"".join(raw), np.uint8)
        self.pool_start = np.concatenate(([0], np.cumsum([len(r) for r in raw])))


def substring_hashes(symbols: np.ndarray, longest: int) -> list[np.ndarray]:
    """For m = 1..longest the hashes of all substrings of m code points of each row."""
    n, width = symbols.shape
    rolling, found = np.zeros((n, width + 1), np.uint64), []
    for m in range(1, min(longest, width) + 1):
        rolling = rolling[:, :-1] * _BASE + symbols[:, m - 1 :] + _U(1)
        found.append(mix(rolling + _U(m)))
    return found


def piece_table(vocabulary: Vocabulary, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position of the piece in the vocabulary or -1, score or -inf) by row, start and length - 1."""
    n, width = symbols.shape
    longest = min(vocabulary.longest, width)
    place = np.full((n, width, longest), -1, np.int32)
    for m, hashes in enumerate(substring_hashes(symbols, longest)):
        at = np.minimum(np.searchsorted(vocabulary.hashes, hashes), len(vocabulary.hashes) - 1)
        place[:, : width - m, m] = np.where(vocabulary.hashes[at] == hashes, at, -1)
    return place, np.where(place >= 0, vocabulary.scores[place], -np.inf)


def best_paths(score: np.ndarray) -> np.ndarray:
    """Whether a piece of the best path begins at each position, by Viterbi; ties go to the shorter last piece.

    A single character without a piece costs UNKNOWN_SCORE.
    """
    n, width, longest = score.shape
    single = np.where(np.isneginf(score[:, :, 0]), UNKNOWN_SCORE, score[:, :, 0])
    best, back = np.zeros((n, width + 1)), np.zeros((n, width + 1), np.int64)
    for end in range(1, width + 1):
        reach = min(longest, end)
        lengths = np.arange(1, reach + 1)
        value = best[:, end - lengths] + np.column_stack(
            (single[:, end - 1], *(score[:, end - m, m - 1] for m in range(2, reach + 1)))
        )
        chosen = value.argmax(1)
        back[:, end] = chosen + 1
        best[:, end] = value[np.arange(n), chosen]
    begins, at = np.zeros((n, width), bool), np.full(n, width)
    while (at > 0).any():
        live = np.flatnonzero(at > 0)
        at[live] -= back[live, at[live]]
        begins[live, at[live]] = True
    return begins


def best_merges(score: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each position once the best merge has been made again and again."""
    n, width, longest = score.shape
    bounds = np.tile(np.arange(width + 2), (n, 1))  # starts of the symbols left; further ones are width
    bounds[:, width + 1] = width
    live = np.arange(n)
    for used in range(width + 2, 3, -1):  # every live word loses one symbol a round
        if not len(live):
            break
        own = bounds[live, :used]
        length = own[:, 2:] - own[:, :-2]
        start = np.minimum(own[:, :-2], width - 1)
        real = (own[:, 1:-1] < width) & (length <= longest)
        value = np.where(real, score[live[:, None], start, np.clip(length, 1, longest) - 1], -np.inf)
        chosen = value.argmax(1)
        some = ~np.isneginf(value[np.arange(len(live)), chosen])
        live, chosen = live[some], chosen[some]
        column = np.arange(used - 1)
        own = own[some]
        bounds[live, : used - 1] = np.where(column > chosen[:, None], own[:, 1:], own[:, :-1])
    begins = np.zeros((n, width + 1), bool)
    np.put_along_axis(begins, bounds, True, axis=1)
    return begins[:, :width]


def merged_bounds(rank_of: dict[str, int], longest: int, word: str) -> list[int]:
    """Where the pieces of one word begin, and its end, as ``best_merges`` has them.

    The heap holds pairs of neighbours as one number: rank, start and length. A pair that has
    changed since is told by its length, since a span of the same length is the same piece.
    """
    n = len(word)
    wide, deep = n.bit_length() + 1, longest.bit_length()
    mask = (1 << wide) - 1
    size, before = [1] * n, [1] * (n + 1)  # length of the symbol from each position, and of the one up to it
    heap = [
        (rank_of[pair] << wide | i) << deep | 2
        for i, pair in enumerate(map(str.__add__, word, word[1:]))
        if longest > 1 and pair in rank_of
    ]
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        length, start = top & ((1 << deep) - 1), top >> deep & mask
        end, middle = start + length, start + size[start]
        if not size[start] or middle >= end or size[middle] != end - middle:
            continue
        size[middle] = 0
        size[start] = before[end] = length
        if start:
            left = start - before[start]
            rank = rank_of.get(word[left:end]) if end - left <= longest else None
            if rank is not None:
                heapq.heappush(heap, (rank << wide | left) << deep | end - left)
        if end < n:
            right = end + size[end]
            rank = rank_of.get(word[start:right]) if right - start <= longest else None
            if rank is not None:
                heapq.heappush(heap, (rank << wide | start) << deep | right - start)
    return [i for i, own in enumerate(size) if own] + [n]


def path_bounds(score_of: dict[str, float], longest: int, word: str) -> list[int]:
    """Where the pieces of one word begin, and its end, as ``best_paths`` has them."""
    n = len(word)
    best, back = [0.0] * (n + 1), [1] * (n + 1)
    for end in range(1, n + 1):
        top = best[end - 1] + score_of.get(word[end - 1], UNKNOWN_SCORE)
        for length in range(2, min(longest, end) + 1):
            own = score_of.get(word[end - length : end])
            if own is not None and best[end - length] + own > top:
                top, back[end] = best[end - length] + own, length
        best[end] = top
    bounds = [n]
    while bounds[-1]:
        bounds.append(bounds[-1] - back[bounds[-1]])
    return bounds[::-1]


def _long_word(vocabulary: Vocabulary, word: str, merges: bool) -> np.ndarray:
    scores, bounds = (vocabulary.rank_of, merged_bounds) if merges else (vocabulary.score_of, path_bounds)
    cuts, ids = bounds(scores, vocabulary.longest, word), []
    for i, j in zip(cuts, cuts[1:]):
        own = vocabulary.id_of.get(word[i:j])
        ids.extend(vocabulary.byte_ids[list(word[i:j].encode())].tolist() if own is None else (own,))
    return np.array(ids, np.int32)


def encode_words(vocabulary: Vocabulary, words: list[str], merges: bool) -> list[np.ndarray]:
    """Ids of each word; a word carries its separators as characters."""
    result: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
    lengths = np.array([len(w) for w in words])
    for i in np.flatnonzero(lengths > LONG_WORD):
        result[i] = _long_word(vocabulary, words[i], merges)
    for width in np.unique(lengths[(lengths > 0) & (lengths <= LONG_WORD)]):
        group = np.flatnonzero(lengths == width)
        step = max(1, BATCH_CELLS // int(width * min(width, vocabulary.longest)))
        for low in range(0, len(group), step):
            part = group[low : low + step]
            symbols = np.array([words[i] for i in part], f"U{width}").view(np.uint32).reshape(len(part), width)
            # numpy drops zeros at the end of a text, but the view holds them as zeros again.
            place, score = piece_table(vocabulary, symbols.astype(np.uint64))
            begins = best_merges(score) if merges else best_paths(score)
            row, start = np.nonzero(begins)
            end = np.append(start[1:], width)
            end[np.append(row[1:] != row[:-1], True)] = width
            at = place[row, start, np.minimum(end - start, place.shape[2]) - 1]
            ids = np.where(at >= 0, vocabulary.ids[at], -1).astype(np.int32)
            cuts = np.searchsorted(row, np.arange(len(part) + 1)).tolist()
            in_bytes = set(row[ids < 0].tolist())
            for k, i in enumerate(part.tolist()):
                own = ids[cuts[k] : cuts[k + 1]]
                if k in in_bytes:
                    own = np.concatenate([
                        [x] if x >= 0 else vocabulary.byte_ids[np.frombuffer(words[i][s].encode(), np.uint8)]
                        for x, s in zip(own, start[cuts[k] : cuts[k + 1]])
                    ]).astype(np.int32)
                result[i] = own
    return result


def gather(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The spans of the pool one after another."""
    total = np.cumsum(length)
    if not len(total) or total[-1] == 0:
        return pool[:0]
    return pool[np.arange(total[-1]) + np.repeat(start - (total - length), length)]


class Encoder:
    """Encodes slices of texts; words met before come from the worker's cache."""

    def __init__(self, model: bytes, merges: bool):
        self.vocabulary, self.merges = Vocabulary(model), merges
        self.clear()

    def clear(self):
        self.keys, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _learn(self, keys: np.ndarray, words: list[str]):
        found = encode_words(self.vocabulary, words, self.merges)
        length = np.array([len(f) for f in found], np.int64)
        start = len(self.pool) + np.cumsum(length) - length
        self.pool = np.concatenate((self.pool, *found))
        keys = np.concatenate((self.keys, keys))
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.start = np.concatenate((self.start, start))[order]
        self.length = np.concatenate((self.length, length))[order]

    def __call__(self, words) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of the slice, n + 1 bounds)."""
        found = PreTokens(words)
        trailing = np.flatnonzero(found.trailing)
        keys = np.concatenate((found.keys, found.trailing[trailing].astype(np.uint64)))
        text = np.concatenate((words.text_of, trailing))
        order = np.argsort(text, kind="stable")  # a text's trailing spaces follow its words
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.pool) > CACHE_TOKENS:
            self.clear()
        at = np.minimum(np.searchsorted(self.keys, distinct), max(len(self.keys) - 1, 0))
        new = self.keys[at] != distinct if len(self.keys) else np.ones(len(distinct), bool)
        if new.any():
            fresh = []
            for i in first[new]:
                if i < len(found.keys):
                    fresh.append(_SEPARATOR + found.text(i).replace(" ", _SEPARATOR))
                else:
                    fresh.append(_SEPARATOR * int(found.trailing[trailing[i - len(found.keys)]]))
            self._learn(distinct[new], fresh)
            at = np.searchsorted(self.keys, distinct)
        at = at[inverse[order]]
        start, length = self.start[at], self.length[at]
        per_text = np.bincount(text[order], length, minlength=len(words.first) - 1).astype(np.int64)
        return gather(self.pool, start, length), np.concatenate(([0], np.cumsum(per_text)))


def decode(vocabulary: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, n + 1 bounds); the space that encoding put before each text goes."""
    start, length = vocabulary.pool_start[ids], np.diff(vocabulary.pool_start)[ids]
    data = gather(vocabulary.pool, start, length)
    ends = np.concatenate(([0], np.cumsum(length)))[bounds]
    opening = ends[:-1][np.diff(ends) > 0]
    drop = opening[data[opening] == 0x20]
    keep = np.ones(len(data), bool)
    keep[drop] = False
    return data[keep], ends - np.searchsorted(drop, ends)


_ENCODERS: dict[tuple, Encoder] = {}  # of this worker process


def _encoder(model: bytes, merges: bool) -> Encoder:
    name = (hash(model), merges)
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(model, merges)
    return _ENCODERS[name]


def _encoded(encoder: Encoder, own: pa.Array, words: Words) -> pa.RecordBatch:
    """What encode_texts() returns for one slice of texts with the ids ``own``."""
    ids, bounds = encoder(words)
    back, ends = decode(encoder.vocabulary, ids, bounds)
    same = np.array_equal(ends, words.text_bounds) and np.array_equal(back, words.data)
    if not same:
        same = [
            np.array_equal(back[a:b], words.data[c:d])
            for a, b, c, d in zip(ends, ends[1:], words.text_bounds, words.text_bounds[1:])
        ]
    return pa.RecordBatch.from_arrays(
        [
            own,
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
            pa.array(np.diff(bounds), pa.int64()),
            pa.array(np.broadcast_to(same, len(own)), pa.bool_()),
        ],
        names=["doc_id", "ids", "n_tokens", "round_trip"],
    )


def encode_texts(
    docs: DataFrame, model: bytes, *, merges: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, ids, n_tokens, round_trip), one for each input row.

    ``ids`` are the tokens without added ones, equal to the library's if ``merges`` fits the
    vocabulary's type (true for BPE, false for unigram). ``round_trip`` tells whether
    decoding them gives the text back; the separator sign of the library itself counts as
    a space. A null or empty text has no tokens. Null ids and repeated rows are kept, other
    columns are not looked at, an empty table gives an empty result, texts are used whole.
    """
    check_separable(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, merges)
        for batch in batches:
            for low, high, words in plain_slices(batch.column(1)):
                yield _encoded(encoder, batch.column(0).slice(low, high - low), words)

    kind = dict(docs.dtypes)[id_col]
    encoded = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        returning_memory(encode), f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean"
    )
    return encoded.withColumnRenamed("doc_id", id_col)


def decode_ids(encoded: DataFrame, model: bytes, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, text) from rows with token ids; null or empty ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _encoder(shared.value, True).vocabulary
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, ends = decode(vocabulary, lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes))))
            texts = [data[a:b].tobytes().decode(errors="replace") for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = dict(encoded.dtypes)[id_col]
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(back, f"doc_id {kind}, text string").withColumnRenamed("doc_id", id_col)
