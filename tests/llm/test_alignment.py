from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from marquee.llm import alignment
from marquee.llm.alignment import _OLD_BLOCKS, Aligner, ByteLevelSide, PieceSide, align_texts, alignment_digest, byte_level_bytes, common_cuts, linked_pairs

TEXTS = [
    "The cat sat on the mat.", "The cat sat on the mat.", "", None, " ", "  two  spaces ", "tabs\tand\nlines\r\n", "<|endoftext|> <s> </s> <unk> <0x41>",
    "naïve café ﬁne Ⅷ", "é combining", "漢字かな交じり文", "emoji 👩‍👩‍👧 🏳️‍🌈", "▁ sign", "nul \x00 sign", "0123456789 3.14", "word " * 200,
    "x" * 2000, "https://example.com/a?b=c&d=e", " no break", "ends with space ", "﻿mark", "Ωmega ΣΊΣΥΦΟΣ",
]


@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        return a.read(), b.read()


def plain(texts, files):
    """The query's columns by sets of ends and loops over all links."""
    one, two = Tokenizer.from_str(files[0]), sentencepiece.SentencePieceProcessor(model_proto=files[1])
    one.encode_special_tokens = True
    signs = byte_level_bytes()
    names = {i: t for t, i in one.get_vocab().items()}
    documents, counts = [], Counter()
    for text in texts:
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids
        b = two.encode(text or "")
        bytes_a = [bytes(signs[c] for c in names[i]) for i in a]
        bytes_b = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in b]
        groups = []
        if text and b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            ends = [list(accumulate(map(len, x))) for x in (bytes_a, bytes_b)]
            low = 0
            for cut in sorted(set(ends[0]) & set(ends[1])):
                groups.append(tuple([i for i, e in zip(ids, own) if low < e <= cut] for ids, own in zip((a, b), ends)))
                low = cut
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        counts.update(set(links))
        documents.append((groups, links))
    most = {}
    for (x, _), n in counts.items():
        most[x] = max(n, most.get(x, 0))
    rows = []
    for groups, links in documents:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(counts[k] == most[k[0]] for k in links), sum(counts[k] for k in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return rows


@pytest.mark.parametrize("pairs", [1 << 21, 40, 0])
def test_equals_brute_force(spark, files, pairs):
    rows = [(i if i % 7 else None, t, 1) for i, t in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(5)
    found = alignment_digest(frame, *files, table_pairs=pairs).collect()
    wanted = plain(TEXTS, files)
    key = lambda r: [(x is None, x if x is not None else 0) for x in r]
    assert sorted((tuple(r) for r in found), key=key) == sorted(((r[0], *w) for r, w in zip(rows, wanted)), key=key)
    assert sum(w[0] > 0 for w in wanted) > 10 and wanted[2] == (0, 0, 0, 0, 0, 0, "")


def test_groups(spark, files):
    frame = spark.createDataFrame([("x", "The cat"), ("y", None)], "id string, body string")
    found = {r.id: r for r in align_texts(frame, *files, id_col="id", text_col="body").collect()}
    assert found["y"].a == found["y"].size_a == [] and sum(found["x"].size_a) == len(found["x"].a) and len(found["x"].size_a) == len(found["x"].size_b)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment_digest(empty, *files).collect() == []


def test_cuts():
    assert common_cuts([0, 1, 2], [0, 0], [1, 2, 1], [3, 1]) == ([2], [1])
    assert common_cuts([0, 1], [1, 0], [1, 2], [1, 2]) == ([2], [2])
    assert common_cuts([], [], [1], [1]) == ([], [])
    assert common_cuts([0, 1, 0], [0, 0], [1, 0], [1]) == ([2, 3], [1, 2])


@pytest.mark.parametrize("at_once", [1, 7, 10**6])
def test_links_of_large_groups(at_once):
    rng = np.random.default_rng(2)
    size_a, size_b = rng.integers(1, 9, 30), rng.integers(1, 9, 30)
    a, b = rng.integers(0, 6, size_a.sum()), rng.integers(0, 50_000, size_b.sum())
    wanted, i, j = Counter(), 0, 0
    for m, n in zip(size_a, size_b):
        wanted.update((x, y) for x in a[i : i + m].tolist() for y in b[j : j + n].tolist())
        i, j = i + m, j + n
    found = [(p >> 32, p & 0xFFFFFFFF, t) for pair, times in linked_pairs(a, b, size_a, size_b, at_once) for p, t in zip(pair.tolist(), times.tolist())]
    assert len(found) == len(wanted) and {(x, y): t for x, y, t in found} == wanted


def test_one_word_of_100_000_signs(spark, files):
    frame = spark.createDataFrame([(1, "x" * 100_000)], "doc_id long, text string")
    row = alignment_digest(frame, *files).first()
    assert row.n_a > 0 and row.n_b > 0 and row.n_links >= row.n_groups > 0 and row.count_sum == row.n_links


def test_ids_equal_the_libraries(spark, files):
    rng = random.Random(4)
    signs = [" ", " ", " ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u0085", "\u2003", "\u200b", "a", "The", "'s", "'", "1", "42", "é", "漢", "!", "...", "🏳", "\x00", "_", "٣", "ß"]
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 30))) for _ in range(3000)]
    one, two = Tokenizer.from_str(files[0]), sentencepiece.SentencePieceProcessor(model_proto=files[1])
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in align_texts(frame, *files).collect()}
    spelt = [i for i in range(len(texts)) if found[i].a]
    assert len(spelt) > 2000
    for i in spelt:
        assert found[i].a == one.encode(" " + texts[i], add_special_tokens=False).ids, texts[i]
        assert found[i].b == two.encode(texts[i]), texts[i]


def test_both_byte_level_libraries_agree_on_old_blocks(files):
    side = ByteLevelSide(files[0])
    assert side.quick is not None
    signs = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000 and _OLD_BLOCKS.fullmatch(chr(i))]
    assert 20_000 < len(signs) < 35_000
    texts = [f" a{c}b {c}1{c} {c}{c}  {c}'s.{c} \n{c}" for c in signs]
    slow = [e.ids for e in side.library.encode_batch(texts, add_special_tokens=False)]
    assert [side.quick.encode_ordinary(t) for t in texts] == slow


@pytest.mark.parametrize("held", [300_000, 5])
def test_lists_of_stretches_equal_those_of_the_whole_text(files, held, monkeypatch):
    monkeypatch.setattr(alignment, "STRETCHES_HELD", held)
    rng = random.Random(5)
    signs = [" ", " ", " ", " ", "  ", "\n", "\t", "\x1c", "\u00a0", "\u0085", "\u2003", "\u3000", "a", "The", "'s", "'", "12", "é", "漢", "!", "🏳", "\x00", "▁", "b" * 70]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(signs, k=rng.randint(1, 25))) for _ in range(4000)]
    aligner = Aligner(ByteLevelSide(files[0]), PieceSide(files[1]))
    assert aligner.separable
    wanted = list(aligner.whole(texts))
    for step in (4100, 50):  # the second time with some stretches known
        found = [x for i in range(0, len(texts), step) for x in aligner(texts[i : i + step])]
        assert [None if x is None or not len(x[0]) else [y.tolist() for y in x] for x in found] == [x and [y.tolist() for y in x] for x in wanted]
    assert max(map(len, aligner.place), default=0) <= alignment.LONG_STRETCH
