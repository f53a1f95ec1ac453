"""Jaccard join, cover tree, components: against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from plain import jaccard_components as plain_components
from plain import shingles, smallest_reachable

from marquee.llm import cover_tree, jaccard_join
from marquee.llm.components import components

LETTERS = [f"w{i}" for i in range(400)]


def edited(generator, words, edits):
    words = list(words)
    for _ in range(edits):
        words[generator.randrange(len(words))] = generator.choice(LETTERS)
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    """Copies, chains of near copies, a passage that many share, short and empty texts."""
    g = random.Random(3)
    passage = [g.choice(LETTERS) for _ in range(40)]
    base = [g.choice(LETTERS) for _ in range(120)]
    found = [" ".join(base)] * 30
    found += [edited(g, base, g.randrange(1, 6)) for _ in range(90)]
    found += [" ".join([*passage, *(g.choice(LETTERS) for _ in range(g.randrange(2, 60)))]) for _ in range(80)]
    for size in (3, 12, 30, 700):
        own = [g.choice(LETTERS) for _ in range(size)]
        found += [edited(g, own, k) for k in (0, 0, 1, 2)]
    found += ["", None, "   ", "one", "ONE", "one two", "one two three four", "One Two Three  Four\n"]
    return dict(enumerate(found))


@pytest.mark.parametrize("size,threshold,least", [(4, 85, 4), (5, 80, 2), (2, 60, 8), (4, 85, 1000)])
def test_jaccard_components(spark, texts, size, threshold, least, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", least)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = jaccard_join.jaccard_components(docs, words=size, threshold=threshold).collect()
    assert {r.doc_id: r.component_id for r in found} == plain_components(texts, size, threshold)
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t, size)) for i, t in texts.items()}


def test_frequent_tokens_fit_their_bound(spark, monkeypatch):
    texts = spark.createDataFrame([(" ".join(f"a{j}" for j in range(i)),) for i in range(1, 40)], "text string")
    all_of_them = jaccard_join.frequent_tokens(texts, 1, 8)
    assert len(all_of_them) == 36
    monkeypatch.setattr(jaccard_join, "FREQUENT_TOKENS", 10)
    few = jaccard_join.frequent_tokens(texts, 1, 8)
    assert 0 < len(few) <= 10 and set(few) < set(all_of_them)


def test_signatures_of_linked_sets_meet():
    """Whatever the division into rare and frequent, sets that are similar enough share a key."""
    g = np.random.default_rng(5)
    for _ in range(400):
        n = int(g.integers(1, 160))
        x = np.unique(g.integers(0, 1 << 62, n, dtype=np.int64).astype(np.uint64))
        out = int(0.15 * len(x) / 2 * g.random() * 2)
        y = np.unique(np.concatenate((x[g.permutation(len(x))[out:]], g.integers(0, 1 << 62, int(out * g.random()), dtype=np.int64).astype(np.uint64))))
        share = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        often = lambda s: (s >> np.uint64(7)) % np.uint64(10) < np.uint64(g_share)
        for g_share in (0, 3, 9, 10):
            keys = [set(jaccard_join.signatures(s, often(s), 85)[0].tolist()) for s in (x, y)]
            assert share < 0.85 or keys[0] & keys[1]


def test_drop_near_copies(spark):
    text = " ".join(LETTERS[:60])
    rows = [(3, text, "a"), (1, text, "b"), (1, text, "b"), (2, None, "c"), (None, text, "d"), (5, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = [tuple(r) for r in jaccard_join.drop_near_copies(docs).collect()]
    assert sorted(kept, key=str) == sorted([rows[1], rows[3], rows[4], rows[5]], key=str)
    assert jaccard_join.drop_near_copies(docs.limit(0)).count() == 0


def test_other_texts_of_a_repeated_id_stay(spark):
    """An id's near copy of a smaller id goes, its other texts stay; of one id's near copies one stays."""
    text, other, third = (" ".join(LETTERS[i : i + 60]) for i in (0, 100, 200))
    rows = [(1, text), (5, text + " end"), (5, other), (5, other), (7, third), (7, third + " end"), (7, "a b"), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(tuple(r) for r in jaccard_join.drop_near_copies(docs).collect())
    assert sum(r in kept for r in rows[4:6]) == 1
    assert [r for r in kept if r not in rows[4:6]] == sorted([rows[0], rows[2], rows[6], rows[7]])


def test_rows_without_id_and_repeated_rows(spark):
    text = " ".join(LETTERS[:30])
    docs = spark.createDataFrame([(None, text), (7, text), (7, text), (8, "other words")], "doc_id long, text string")
    found = sorted((tuple(r) for r in jaccard_join.jaccard_components(docs).collect()), key=str)
    assert found == sorted([(None, 26, None), (7, 26, 7), (7, 26, 7), (8, 1, 8)], key=str)


def test_components(spark):
    g = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)]
    links += [(g.randrange(300, 400), g.randrange(300, 400)) for _ in range(80)] + [(5, 5), (0, 1), (1, 0)]
    want = smallest_reachable({x for p in links for x in p if p[0] != p[1]}, links)
    frame = spark.createDataFrame([*links, (None, 4)], "a long, b long")
    assert {r.node: r.component for r in components(frame).collect()} == want
    assert components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("block", [64, 4096])
def test_cover_tree(spark, block, monkeypatch):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    g = np.random.default_rng(2)
    centres = g.standard_normal((12, 16))
    x = np.concatenate((g.standard_normal((200, 16)), np.repeat(centres, 15, 0) + 0.1 * g.standard_normal((180, 16))))
    x = np.concatenate((x, x[:20], 3 * x[20:25]))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    links = list(zip(*map(np.ndarray.tolist, np.nonzero(linked))))
    want = smallest_reachable(range(len(x)), links)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(-1, None), (-2, [0.0] * 16), (-3, [float("nan")] * 16), (-4, []), (-5, [None] + [1.0] * 15), (None, [1.0] * 16)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in cover_tree.near_duplicates(frame).collect()}
    assert len(found) == len(rows) + len(odd)
    for i in want:
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (linked[i].sum(), want[i], want[i] == i)
    assert all(found[i].n_links == 0 and found[i].component_id == i for i, _ in odd if i is not None)
    assert found[None].component_id is None and not found[None].kept


def test_cover_tree_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.near_duplicates(empty).count() == 0


def test_levels_are_nested_and_cover():
    x = np.random.default_rng(0).standard_normal((300, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    levels = cover_tree.nested_levels(x)
    for k, radius in enumerate(cover_tree.RADII):
        assert (np.linalg.norm(x - x[levels[:, k]], axis=1) <= radius + 1e-3).all()
        if k:  # a node's vectors have one parent
            assert len(set(zip(levels[:, k].tolist(), levels[:, k - 1].tolist()))) == len(set(levels[:, k].tolist()))
