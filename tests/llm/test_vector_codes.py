from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from marquee.llm import vector_codes
from marquee.llm.vector_codes import compress_vectors, distinct_parts, nearest_entries


def plain(rows, parts, entries, rounds):
    """Code and error of every kept row (id, vector, label) in order, label errors and digest, by loops over Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((i, v) for i, v, _ in kept if i is not None)
    dims = len(first[0][1])
    first = [v for _, v in first if len(v) == dims][:entries]
    width = dims // parts
    books = [[v[p * width : (p + 1) * width] for v in first] for p in range(parts)]

    def assign(v):
        out = []
        for p, book in enumerate(books):
            own = v[p * width : (p + 1) * width]
            out.append(min((sum((x - y) ** 2 for x, y in zip(own, e)), i) for i, e in enumerate(book)))
        return out

    fitting = [k for k in kept if len(k[1]) == dims]
    for _ in range(rounds):
        found = [(v, assign(v)) for _, v, _ in fitting]
        for p in range(parts):
            for e in range(len(first)):
                own = [v[p * width : (p + 1) * width] for v, a in found if a[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    coded = []
    for i, v, label in kept:
        a = assign(v) if len(v) == dims else None
        coded.append((i, label, a and "".join(f"{e:02x}" for _, e in a), a and sum(d for d, _ in a)))
    totals = {}
    for _, label, _, error in coded:
        if error is not None:
            totals[label] = totals.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, c, e, totals.get(label), digest) for i, label, c, e in coded]


def order(rows):
    return sorted(rows, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_equals_brute_force(spark, limit):
    rng = random.Random(3)
    grid = [-0.5, -1 / 256, -0.001, 0.0, 0.25, 1.0]  # few values, so that parts repeat and distances tie
    rows = [(i, [rng.choice(grid) for _ in range(16)], rng.choice([1, 2, None])) for i in range(150)]
    rows += [(i, [rng.gauss(0, 1) for _ in range(16)], 1) for i in range(100, 200)]
    rows += [(500, None, 1), (501, [None] * 16, 1), (502, [math.nan] * 16, 2), (503, [math.inf] * 16, 2), (504, [0.5] * 8, 9), (505, [], 2), (None, [0.1] * 16, None)]
    rows += rows[:20]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, own_id int").repartition(6)
    found = compress_vectors(frame, parts=4, entries=10, rounds=2, broadcast_bytes=limit)
    assert order(tuple(r) for r in found.collect()) == order(plain(rows, 4, 10, 2))


def test_other_types_and_few_vectors(spark):
    rows = [("b", [1.0, 2.0], "x"), ("a", [0.0, -2.0], None), ("a", [0.0, -2.0], None)]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<float>, label string")
    found = compress_vectors(frame, parts=2)
    assert order(tuple(r) for r in found.collect()) == order(plain(rows, 2, 64, 2))


def test_nothing_to_code(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert compress_vectors(frame).collect() == []
    odd = spark.createDataFrame([(1, [0.5, 0.5, 0.5], 1), (2, [1e9, 0.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    assert [(r.vec_id, r.code, r.error) for r in compress_vectors(odd).collect()] == [(1, None, None)]
    nobody = spark.createDataFrame([(None, [0.5] * 16, 1)], "vec_id long, embedding array<double>, label int")
    assert [(r.code, r.error, r.label_error) for r in compress_vectors(nobody).collect()] == [(None, None, None)]


@pytest.mark.parametrize("block", [3, 2048])
def test_trie_finds_the_nearest(monkeypatch, block):
    monkeypatch.setattr(vector_codes, "BLOCK", block)
    rng = np.random.default_rng(1)
    for width, spread in ((1, 9), (3, 4), (4, 300)):
        rows, book = rng.integers(-spread, spread, (3000, width)), rng.integers(-spread, spread, (17, width))
        parts, inverse, times = distinct_parts(rows)
        assert (parts[inverse] == rows).all() and times.sum() == len(rows) and len(parts) == len({*map(tuple, rows.tolist())})
        assert [*map(tuple, parts.tolist())] == sorted({*map(tuple, rows.tolist())})
        entry, distance = nearest_entries(parts, book)
        squares = ((parts[:, None] - book[None]) ** 2).sum(2)
        assert (entry == squares.argmin(1)).all() and (distance == squares.min(1)).all()
