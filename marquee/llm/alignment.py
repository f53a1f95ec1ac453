"""Alignment of the tokens that two tokenizers make of the same text, and how often they go together.

The cumulative byte ends of either side become a dictionary from end to index. Where both
have an end (an intersection of hash sets), the sorted common ends cut both id lists into
groups; inside a group every token of one side is linked with every token of the other.

Neither tokenizer joins signs across a space between two words, so no group does. Texts are
cut there, a worker keeps the groups of the stretches that it has met, and a text's lists are
those of its stretches one after another.

Three passes: encode and cut (written to the shared folder in a compact form, so no text is
encoded twice); count for each pair of ids the documents that hold it linked; add the counts
up. Links are expanded in numpy for a slice of documents at a time. Pairs are counted inside
the tasks first, so only distinct pairs of a slice are shuffled. The most frequent pairs go to
the last pass as a broadcast of bounded size; rarer ones, if there are any, meet their counts
in a join, in which no pair is hot.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.pieces import gather
from marquee.llm.words import give_back
from marquee.session import enable_checkpoints, scratch_path

TABLE_PAIRS = 1 << 21  # pairs in the broadcast lookup, 17 bytes each
SLICE_BYTES = 1 << 18  # text that is encoded at a time
SLICE_TOKENS = 200_000  # tokens whose links are expanded at a time
LINKS_AT_ONCE = 4_000_000  # links of one document that are expanded at a time
PAIRS_HELD = 1_000_000  # pairs that a task collects before it adds up their counts
STRETCHES_HELD = 300_000  # stretches of text in a worker's cache; it starts anew when full
TOKENS_HELD = 4_000_000  # places for their tokens; more start the cache anew too
LONG_STRETCH = 64  # signs; longer stretches do not stay in the cache

_SEPARATOR = "▁"
# How byte-level vocabularies of this family split a text. A fixed value.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Texts of these old blocks alone (letters, digits, white space and signs of the first Unicode
# versions) are split alike by both byte-level libraries; tests go through every character.
_OLD_BLOCKS = re.compile("[\\x00-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u045f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]*")


# Where a text may be cut: at a space with no white space beside it.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# A text to tell whether a library leaves all signs as they are.
_PROBE = "a\tb\nc ﬁ\u00a0\u00b4 e\u0301 Å"


def byte_level_bytes() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others follow each other from sign 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevelSide:
    """Tokens of a byte-level tokenizer file; the text gets one space in front."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.library = tokenizers.Tokenizer.from_str(definition)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        signs = byte_level_bytes()
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        vocabulary = self.library.get_vocab()
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = token not in special and all(c in signs for c in token)
            self.bytes[i] = bytes(signs[c] for c in token) if known else token.encode()
        self.quick = self._ranked(vocabulary, special)
        self.separable = self._splits_at_spaces()

    def _splits_at_spaces(self) -> bool:
        """Whether the file splits texts by the pattern above, and nothing else sees more than one part."""
        definition = json.loads(self.library.to_str())
        first = definition.get("pre_tokenizer") or {}
        by_pattern = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
        return bool(by_pattern) and definition.get("normalizer") is None and all(t["special"] for t in definition.get("added_tokens") or [])

    def _ranked(self, vocabulary: dict[str, int], special: set[str]):
        """The same vocabulary for the faster library, if its ids stand in the order of its merges; else None."""
        plain = sorted((i, self.bytes[i]) for token, i in vocabulary.items() if token not in special)
        merges = json.loads(self.library.to_str())["model"].get("merges") or []
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        if made != sorted(made) or len(made) + 256 != len(plain) or self.library.normalizer is not None:
            return None
        ranks = {token: i for i, token in plain}
        return tiktoken.Encoding("byte_level", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text as the tokenizer file gives them, by the faster library where both surely agree."""
        found = [self.quick.encode_ordinary(" " + t) if self.quick and _OLD_BLOCKS.fullmatch(t) else None for t in texts]
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, e in zip(rest, self.library.encode_batch([" " + texts[i] for i in rest], add_special_tokens=False)):
            found[i] = e.ids
        return found


class PieceSide:
    """Tokens of a SentencePiece model, which puts the space in front by itself."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(_SEPARATOR, " ").encode()
            for i, p in enumerate(pieces)
        ]
        # Separators only begin a piece, and nothing is rewritten, so a word begins a piece too.
        alone = not any(_SEPARATOR in p.lstrip(_SEPARATOR) for p in pieces)
        self.separable = alone and b"".join(map(self.bytes.__getitem__, self.encode([_PROBE])[0])) == (" " + _PROBE).encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


def common_cuts(ids_a: list[int], ids_b: list[int], length_a: list[int], length_b: list[int]) -> tuple[list[int], list[int]]:
    """Where the groups end in either list: the indexes behind the tokens that end at a common byte.

    ``length`` gives the bytes of each id. Tokens without bytes belong to the group before them.
    """
    ends_a = dict(zip(accumulate(map(length_a.__getitem__, ids_a)), range(1, len(ids_a) + 1)))
    ends_b = dict(zip(accumulate(map(length_b.__getitem__, ids_b)), range(1, len(ids_b) + 1)))
    common = sorted(ends_a.keys() & ends_b.keys())
    return list(map(ends_a.__getitem__, common)), list(map(ends_b.__getitem__, common))


class Rows:
    """Lists of 32-bit numbers end to end, in arrays that double when they are full."""

    def __init__(self):
        self.data, self.bounds, self.n = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0

    def add(self, data: np.ndarray, bounds: np.ndarray) -> None:
        """More lists; ``bounds`` is where each ends."""
        low = self.bounds[self.n]
        while len(self.data) < low + len(data):
            self.data = np.concatenate((self.data, np.zeros_like(self.data)))
        while len(self.bounds) <= self.n + len(bounds):
            self.bounds = np.concatenate((self.bounds, np.zeros_like(self.bounds)))
        self.data[low : low + len(data)] = data
        self.bounds[self.n + 1 : self.n + 1 + len(bounds)] = low + bounds
        self.n += len(bounds)

    def take(self, rows: np.ndarray, per_text: np.ndarray) -> list[np.ndarray]:
        """The chosen lists one after another, a list for each run of ``per_text`` rows."""
        start = self.bounds[rows]
        length = self.bounds[rows + 1] - start
        ends = np.concatenate(([0], np.cumsum(length)))[np.cumsum(per_text)]
        return np.split(gather(self.data, start, length), ends[:-1])


class Aligner:
    """Lists (a, b, size_a, size_b) of texts; those of stretches met before are kept."""

    def __init__(self, side_a, side_b):
        self.a, self.b = side_a, side_b
        self.length_a, self.length_b = ([len(x) for x in side.bytes] for side in (side_a, side_b))
        self.separable = side_a.separable and side_b.separable
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}  # row of each stretch, -1 if its tokens do not spell it
        self.rows = [Rows() for _ in range(4)]

    def _spelt(self, text: str, a: list[int], b: list[int]) -> bool:
        bytes_a, bytes_b = self.a.bytes.__getitem__, self.b.bytes.__getitem__
        return text != "" and b"".join(map(bytes_a, a)) == (" " + text).encode() == b"".join(map(bytes_b, b))

    def whole(self, texts: list[str]) -> Iterator[tuple | None]:
        """Lists of texts that are encoded as they are; None where the tokens do not spell the text."""
        for text, a, b in zip(texts, self.a.encode(texts), self.b.encode(texts)):
            if self._spelt(text, a, b):
                cuts = common_cuts(a, b, self.length_a, self.length_b)
                yield np.array(a, np.int32), np.array(b, np.int32), *(np.diff(np.array(own, np.int32), prepend=0) for own in cuts)
            else:
                yield None

    def _learn(self, plain: list[str], odd: list[str]) -> None:
        """Stretches are encoded as one text, whose lists are then cut at their ends; odd ones singly."""
        text = " ".join(plain)
        (a,) = self.a.encode([text])
        # This library is slower on long texts.
        b = list(chain.from_iterable(self.b.encode([" ".join(plain[i : i + 8]) for i in range(0, len(plain), 8)])))
        if self._spelt(text, a, b):
            cut_a, cut_b = (np.array([0, *own], np.int32) for own in common_cuts(a, b, self.length_a, self.length_b))
            byte_ends = np.array([0, *accumulate(map(self.length_a.__getitem__, a))])
            ends = np.cumsum([len(s.encode()) + 1 for s in plain])
            last = np.searchsorted(byte_ends[cut_a], ends)  # group that ends with each stretch
            self._keep(plain, (np.array(a, np.int32), np.array(b, np.int32), np.diff(cut_a), np.diff(cut_b)), (cut_a[last], cut_b[last], last, last))
        else:
            odd = odd + plain
        for s, lists in zip(odd, self.whole(odd)):
            if lists is None:
                self.place[s] = -1
            else:
                self._keep([s], lists, [np.array([len(x)]) for x in lists])

    def _keep(self, stretches: list[str], lists, bounds) -> None:
        self.place.update(zip(stretches, range(self.rows[0].n, self.rows[0].n + len(stretches))))
        for rows, *more in zip(self.rows, lists, bounds):
            rows.add(*more)

    def __call__(self, texts: list[str]) -> list[tuple | None]:
        if not self.separable:
            return list(self.whole(texts))
        parts = [t.split(" ") for t in texts]
        new = set().union(*parts).difference(self.place)
        odd = _odd(new)
        if odd:
            parts = [own if odd.isdisjoint(own) else _CUT.split(t) for t, own in zip(texts, parts)]
            new = set().union(*parts).difference(self.place)
        if len(self.place) + len(new) > STRETCHES_HELD or len(self.rows[0].data) > TOKENS_HELD:
            self.clear()
            new = set().union(*parts)
        odd = _odd(new)
        self._learn(list(new - odd), list(odd))
        rows = np.fromiter(map(self.place.__getitem__, chain.from_iterable(parts)), np.int64)
        per_text = np.array([len(own) for own in parts])
        found = list(zip(*(x.take(np.maximum(rows, 0), per_text) for x in self.rows)))
        unspelt = np.repeat(np.arange(len(texts)), per_text)[rows < 0]
        for i in np.unique(unspelt).tolist():  # where a stretch is not spelt, only the text as a whole tells
            (found[i],) = self.whole([texts[i]])
        for s in odd.union(s for s in new if len(s) > LONG_STRETCH):
            del self.place[s]
        return found


def _odd(stretches: set[str]) -> set[str]:
    """Those that are empty, have white space at an end or hold the piece library's own sign for a space."""
    return {s for s in stretches if not s or _SEPARATOR in s or s.strip() != s}


_ALIGNERS: dict[int, Aligner] = {}  # of this worker process


def _aligner(definition: str, model: bytes) -> Aligner:
    name = hash((definition, model))
    if name not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[name] = Aligner(ByteLevelSide(definition), PieceSide(model))
    return _ALIGNERS[name]


def _packed(lists: tuple | None) -> bytes:
    """Four lists of whole numbers (none: empty ones), each in the smallest type that holds it."""
    arrays = lists or [np.zeros(0, np.int32)] * 4
    kinds = [np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8) for x in arrays]
    head = np.array([[k.itemsize, len(x)] for k, x in zip(kinds, arrays)], np.int64)
    return head.tobytes() + b"".join(x.astype(k).tobytes() for k, x in zip(kinds, arrays))


def _unpacked(data: bytes) -> list[np.ndarray]:
    head, at, lists = np.frombuffer(data, np.int64, 8).tolist(), 64, []
    for size, n in zip(head[::2], head[1::2]):
        lists.append(np.frombuffer(data, f"u{size}", n, at).astype(np.int64))
        at += size * n
    return lists


def _packed_rows(docs: DataFrame, definition: str, model: bytes) -> DataFrame:
    """(doc_id, lists) of rows (doc_id, text): the packed ids and group sizes of both sides."""
    shared = docs.sparkSession.sparkContext.broadcast((definition, model))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)

        def of_slice(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
            rows = list(map(_packed, aligner(texts)))
            return pa.RecordBatch.from_arrays([ids, pa.array(rows, pa.binary())], names=["doc_id", "lists"])

        for batch in batches:
            low, texts, held = 0, [], 0
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py() or "")
                held += len(texts[-1])
                if held >= SLICE_BYTES:
                    yield of_slice(batch.column(0).slice(low, len(texts)), texts)
                    low, texts, held = i + 1, [], 0
            if texts:
                yield of_slice(batch.column(0).slice(low), texts)
            give_back()

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(align, f"doc_id {kind}, lists binary")


def _lists(rows: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(rows).astype(np.int32), pa.int32()))


def align_texts(docs: DataFrame, definition: str, model: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, a, b, size_a, size_b), one for each input row: both id lists and the sizes of their groups.

    ``definition`` is the content of a byte-level tokenizer file (side a, which gets a space
    before the text), ``model`` that of a SentencePiece file (side b). Special tokens are
    neither added nor recognised. A null or empty text, and one whose tokens do not spell a
    space and the text on both sides, has no tokens. Null ids and repeated rows are kept,
    other columns are not looked at, an empty table gives an empty result, and texts of any
    length are encoded whole.
    """
    names = ["a", "b", "size_a", "size_b"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                columns = zip(*(_unpacked(x.as_py()) for x in part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), *(_lists(list(c)) for c in columns)], names=["doc_id", *names])

    packed = _packed_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), definition, model)
    kind = dict(packed.dtypes)["doc_id"]
    aligned = packed.mapInArrow(spread, f"doc_id {kind}, " + ", ".join(f"{c} array<int>" for c in names))
    return aligned.withColumnRenamed("doc_id", id_col)


def _weighted(ids: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(id, group, times, tokens of each group) of the distinct ids in each group."""
    key, times = np.unique(group << 32 | ids, return_counts=True)
    return key & 0xFFFFFFFF, key >> 32, times, np.bincount(key >> 32, minlength=groups)


def linked_pairs(
    a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, at_once: int = LINKS_AT_ONCE
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks (pair, times) of the distinct id pairs linked in a document; a pair is a << 32 | b, in one chunk only."""
    a, b, size_a, size_b = (x.astype(np.int64) for x in (a, b, size_a, size_b))
    groups = len(size_a)
    if not groups:
        return
    group_a, times_a, times_b = np.repeat(np.arange(groups), size_a), None, None
    links = int((size_a * size_b).sum())
    if links > at_once:
        # Many tokens in a group: equal ones are taken together first.
        a, group_a, times_a, size_a = _weighted(a, group_a, groups)
        b, _, times_b, size_b = _weighted(b, np.repeat(np.arange(groups), size_b), groups)
        links = int((size_a * size_b).sum())
    start_b = np.cumsum(size_b) - size_b
    chunks = -(-links // at_once)
    for turn in range(chunks):
        mine = np.flatnonzero(a % chunks == turn) if chunks > 1 else np.arange(len(a))
        partners = size_b[group_a[mine]]
        left = np.repeat(mine, partners)
        right = np.arange(len(left)) - np.repeat(np.cumsum(partners) - partners, partners) + np.repeat(start_b[group_a[mine]], partners)
        pair = a[left] << 32 | b[right]
        if times_a is None:
            yield np.unique(pair, return_counts=True)
        else:
            distinct, inverse = np.unique(pair, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, inverse, times_a[left] * times_b[right])
            yield distinct, total


@dataclass
class AlignedSlice:
    """Lists of some consecutive documents end to end; ``rows`` numbers them within their batch."""

    rows: np.ndarray
    a: np.ndarray
    b: np.ndarray
    size_a: np.ndarray
    size_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Chunks (row, pair, times); a pair of a row may come again within its chunk, but in no other."""
        if len(self.rows) == 1:
            for pair, times in linked_pairs(self.a, self.b, self.size_a, self.size_b):
                yield np.full(len(pair), self.rows[0]), pair, times
            return
        row = np.repeat(np.repeat(self.rows, self.n_groups), self.size_a)  # of each token of a
        partners = np.repeat(self.size_b, self.size_a)
        first = np.repeat(np.cumsum(self.size_b) - self.size_b, self.size_a)
        right = np.arange(int(partners.sum())) - np.repeat(np.cumsum(partners) - partners - first, partners)
        pair = np.repeat(self.a << 32, partners) | self.b[right]
        yield np.repeat(row, partners), pair, np.ones(len(pair), np.int64)

    def texts(self) -> list[str]:
        """The groups of each document as a1,a2|b1;a3|b2,b3."""
        names = _names(int(max(self.a.max(initial=0), self.b.max(initial=0))) + 1)
        end_a, end_b = np.cumsum(self.size_a), np.cumsum(self.size_b)
        before = np.concatenate(([0], (end_a + end_b)[:-1])) if len(end_a) else end_a
        code = np.zeros(len(self.a) + len(self.b), np.int64)
        for ids, size, own, start, last in (
            (self.a, self.size_a, end_a, before, 1),
            (self.b, self.size_b, end_b, before + self.size_a, 2),
        ):
            sign = np.zeros(len(ids), np.int64)
            sign[own - 1] = last  # what follows the last token of a group
            code[np.arange(len(ids)) - np.repeat(own - size, size) + np.repeat(start, size)] = 3 * ids + sign
        parts, bounds = code.tolist(), np.concatenate(([0], np.cumsum(self.n_a + self.n_b))).tolist()
        return ["".join(map(names.__getitem__, parts[i:j]))[:-1] for i, j in zip(bounds, bounds[1:])]


_NAMES: list[str] = []  # of this worker process: each number with a comma, a bar and a semicolon


def _names(n: int) -> list[str]:
    for i in range(len(_NAMES) // 3, n):
        _NAMES.extend((f"{i},", f"{i}|", f"{i};"))
    return _NAMES


def _slices(column: pa.Array) -> Iterator[AlignedSlice]:
    """All rows of packed lists; a document with very many links is a slice of its own."""
    held, size = [], 0

    def joined() -> AlignedSlice:
        rows, lists = zip(*held)
        a, b, size_a, size_b = (np.concatenate(x) for x in zip(*lists))
        n_a, n_b, n_groups = (np.array([len(x[k]) for x in lists], np.int64) for k in (0, 1, 2))
        return AlignedSlice(np.array(rows, np.int64), a, b, size_a, size_b, n_a, n_b, n_groups)

    for i in range(len(column)):
        lists = _unpacked(column[i].as_py())
        links = int((lists[2] * lists[3]).sum())
        if held and (size >= SLICE_TOKENS or size + links >= LINKS_AT_ONCE):
            yield joined()
            held, size = [], 0
        held.append((i, lists))
        size += links
    if held:
        yield joined()


def pair_counts(packed: DataFrame) -> DataFrame:
    """(a, b, n, best): rows of packed lists that hold the pair linked, and whether no other pair of a has more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def added_up() -> pa.RecordBatch:
            pairs, times = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, np.int64),) * 2
            distinct, inverse = np.unique(pairs, return_inverse=True)
            total = np.zeros(len(distinct), np.int64)
            np.add.at(total, inverse, times)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (distinct >> 32, distinct & 0xFFFFFFFF, total)], names=["a", "b", "n"])

        for batch in batches:
            for part in _slices(batch.column(0)):
                for row, pair, _ in part.links():
                    pairs, place = np.unique(pair, return_inverse=True)
                    once = np.unique(row * len(pairs) + place)  # a pair counts once in a row
                    held.append((pairs, np.bincount(once % max(len(pairs), 1), minlength=len(pairs))))
                    size += len(pairs)
                    if size >= PAIRS_HELD:
                        yield added_up()
                        held, size = [], 0
        yield added_up()
        give_back()

    sent = packed.select("lists").mapInArrow(count, "a long, b long, n long")
    counts = sent.groupBy("a", "b").agg(F.sum("n").alias("n")).checkpoint()
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # one row for each id of the vocabulary
    return counts.join(F.broadcast(most), "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_digest(
    docs: DataFrame,
    definition: str,
    model: bytes,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_pairs: int = TABLE_PAIRS,
) -> DataFrame:
    """Rows (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one for each input row.

    Links are all pairs of a token of a and one of b in a common group. A pair's count is the
    number of rows of the whole table that hold it linked; ``n_best`` counts the links whose
    pair has the highest count of its id of a (ties included), ``count_sum`` adds the counts of
    all links. Rows without tokens (see ``align_texts``, also for nulls, repeated rows and empty
    tables) have zeros and an empty ``groups_sha256``. A repeated row counts as often as it occurs.
    """
    spark = docs.sparkSession
    enable_checkpoints(spark)
    path = scratch_path(spark, "aligned")
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    _packed_rows(plain, definition, model).write.option("compression", "zstd").parquet(path)
    packed = spark.read.parquet(path)
    counts = pair_counts(packed).checkpoint()
    number = counts.count()
    common = counts if number <= table_pairs else counts.orderBy(F.desc("n"), "a", "b").limit(table_pairs)
    table = common.toArrow()  # at most table_pairs rows
    keys = table["a"].to_numpy() << 32 | table["b"].to_numpy()
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order]))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = shared.value
        for batch in batches:
            n = batch.num_rows
            n_links, n_best, count_sum = np.zeros((3, n), np.int64)
            lengths, digests, missing = np.zeros((3, n), np.int64), [], [[] for _ in range(n)]
            for part in _slices(batch.column(1)):
                lengths[:, part.rows] = part.n_a, part.n_b, part.n_groups
                digests += [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in part.texts()]
                for row, pair, times in part.links():
                    at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
                    known = keys[at] == pair if len(keys) else np.zeros(len(pair), bool)
                    np.add.at(n_links, row, times)
                    if known.any():
                        at, own = at[known], times[known]
                        np.add.at(n_best, row[known], own * best[at])
                        np.add.at(count_sum, row[known], own * counts[at])
                    for i in np.flatnonzero(~known):
                        missing[row[i]].append({"a": int(pair[i]) >> 32, "b": int(pair[i]) & 0xFFFFFFFF, "times": int(times[i])})
            pairs = pa.array(missing, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("times", pa.int64())])))
            numbers = [pa.array(x) for x in (*lengths, n_links, n_best, count_sum)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(digests, pa.string()), pairs], names=[*names, "missing"])
        give_back()

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kind = dict(plain.dtypes)["doc_id"]
    numbers = ", ".join(f"{c} long" for c in names[1:7])
    schema = f"doc_id {kind}, {numbers}, groups_sha256 string, missing array<struct<a:long,b:long,times:long>>"
    found = packed.mapInArrow(look_up, schema)
    if number > table_pairs:
        found = _with_rare_pairs(found, counts)
    return found.select(F.col("doc_id").alias(id_col), *names[1:])


def _with_rare_pairs(found: DataFrame, counts: DataFrame) -> DataFrame:
    """The rows with the counts of the pairs that the broadcast lookup left open."""
    path = scratch_path(found.sparkSession, "looked-up")
    found.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    found = found.sparkSession.read.parquet(path)
    rest = (
        found.select("row", F.inline("missing"))
        .join(counts, ["a", "b"])
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    )
    more = {c: F.col(c) + F.coalesce(m, F.lit(0)) for c, m in (("n_best", F.col("more_best")), ("count_sum", F.col("more_sum")))}
    return found.join(rest, "row", "left").withColumns(more)
