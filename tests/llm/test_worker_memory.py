"""Memory that encoding and the toxicity fit take in a worker, and what a task leaves there."""

from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from marquee.llm import pieces, toxicity, words


@pytest.fixture(scope="module")
def model() -> bytes:
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def test_texts_are_copied_slice_by_slice():
    column = pa.array([None, *("a▁b c  d" * 1500 for _ in range(1000)), "", "▁"])
    before, most, ends, seen = pa.total_allocated_bytes(), 0, [0], 0
    for low, high, found in pieces.plain_slices(column.slice(1)):
        most = max(most, pa.total_allocated_bytes() - before)
        assert low == ends[-1] and len(found.first) == high - low + 1
        ends.append(high)
        seen += len(found.start)
    assert ends[-1] == len(column) - 1 and seen == 1000 * (3 * 1500 + 1)
    assert most < column.nbytes / 4


def test_piece_tables_stay_small_however_many_words_are_new(model):
    vocabulary = pieces.Vocabulary(model)
    new = [f"▁{i:09d}x" for i in range(40_000)]
    tracemalloc.start()
    try:
        found = pieces.encode_words(vocabulary, new, True)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == len(new) and all(len(ids) for ids in found)
    assert peak < 64e6


def test_a_task_returns_memory_after_it_has_let_go_of_its_own(monkeypatch):
    events = []

    class Held:
        def __del__(self):
            events.append("freed")

    def task(batches):
        held = Held()
        for batch in batches:
            yield batch, held is None

    monkeypatch.setattr(words, "give_back", lambda: events.append("returned"))
    assert [b for b, _ in words.returning_memory(task)(iter([1, 2]))] == [1, 2]
    assert events == ["freed", "returned"]


def sample_rows(n_texts: int, n_words: int, seed: int):
    """Random words of texts in the form that _tokenised() gives, and the labels of the texts; a sentence has about ten."""
    g = np.random.default_rng(seed)
    rows = []
    for i in range(n_texts):
        own = np.empty((n_words, toxicity.TEMPLATES + 1), np.int32)
        own[:, :-1] = g.integers(0, 5000, (n_words, 1)) * np.arange(1, toxicity.TEMPLATES + 1)
        own[i % 2 :: 40, :-1] = 7 if i % 2 else 9
        own[:, -1] = g.random(n_words) < 0.1
        own[0, -1] = 1
        rows.append(own)
    return rows, np.arange(n_texts) % 2


def test_toxicity_fit_takes_little_more_than_its_features(monkeypatch):
    monkeypatch.setattr(toxicity, "ROUNDS", 2)
    rows, labels = sample_rows(600, 5000, 1)
    tracemalloc.start()
    try:
        model = toxicity.fit_documents(rows, labels, (300, 300))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.theta is not None and peak < 75 * 3_000_000


def test_toxicity_fit_is_the_same_in_groups(monkeypatch):
    monkeypatch.setattr(toxicity, "ROUNDS", 5)
    rows, labels = sample_rows(40, 200, 2)
    rows[3] = rows[3][:0]
    whole = toxicity.fit_documents(rows, labels, (30, 10))
    for words_at_a_time in (100, 1500):
        monkeypatch.setattr(toxicity, "GROUP_WORDS", words_at_a_time)
        model = toxicity.fit_documents(rows, labels, (30, 10))
        assert np.allclose(model.theta, whole.theta, rtol=1e-5, atol=1e-6) and np.allclose(model.moves, whole.moves)
        assert np.allclose(model.calibration, whole.calibration) and model.bias == whole.bias
