"""Toxicity and quality: exact inference on small chains, held-out accuracy, odd inputs."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import quality, toxicity
from marquee.llm.labels import logistic_fit, sigmoid


def test_marginals_against_all_paths():
    g = np.random.default_rng(0)
    lengths = np.array([1, 5, 3, 7])
    start = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    emission, moves = g.standard_normal(lengths.sum()), g.standard_normal((2, 2))
    got = sigmoid(toxicity.marginals(emission, start, lengths, moves)[0])
    for s, n in zip(start, lengths):
        weights, ones = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(emission[s : s + n] @ np.array(path) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            weights, ones = weights + w, ones + w * np.array(path)
        assert np.allclose(got[s : s + n], ones / weights)


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize("operator,label,least", [("toxicity", "toxic", 0.98), ("quality", "quality", 0.98)])
def test_held_out_accuracy(spark, operator, label, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    if operator == "toxicity":
        scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))
    else:
        scored = quality.score_quality(docs, quality.fit_quality(docs, labels))
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == r[label] for r in held]) >= least
    assert all(0 <= r.score <= 1 for r in rows) and scored.count() == docs.count()


def test_labels_of_held_out_documents_do_not_matter(tables, spark):
    docs, labels = tables
    docs = docs.filter("doc_id < 200")
    turned = labels.withColumn("toxic", F.expr("IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - toxic, toxic)"))
    one, two = (toxicity.fit_toxicity(docs, t) for t in (labels, turned))
    assert np.array_equal(one.theta, two.theta) and np.array_equal(one.calibration, two.calibration)


def test_spans_are_code_points(tables, spark):
    docs, labels = tables
    model = toxicity.fit_toxicity(docs, labels)
    text = "Ünder the ther. You é IDIOT, of ther."
    frame = spark.createDataFrame([(1, text), (2, ""), (None, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.score_toxicity(frame, model).collect()}
    assert found[1].spans == "22:27" and found[1].n_spans == 1 and text[22:27] == "IDIOT"
    assert found[2].spans == found[None].spans == "" and found[2].predicted == found[None].predicted == 0
    assert {r.doc_id for r in toxicity.drop_toxic(frame.withColumn("score", F.lit("x")), model).collect()} >= {2, None}


def test_toxic_forms_in_set_phrases_and_in_the_tail():
    """Forms with one left neighbour, and many forms of 1.5 percent of toxic documents each, are toxic; those of near copies not."""
    g = np.random.default_rng(6)
    texts = []
    for i in range(2000):
        words = [f"{'abcdefghij'[j % 10]}{j:03d}" for j in g.integers(0, 300, 60)]
        if i < 1000:
            words[30:30] = ["you", "phrasal"] if i % 10 == 0 else ["any", f"{i % 66:02d}tail"]
        if i >= 1960:  # near copies, all labelled toxic
            words = [f"a{j:03d}" for j in range(60)]
            words[i % 60] = "x1"
            words[59] = "copied"
        texts.append(" ".join(words).encode())
    labels = np.array([int(i < 1000 or i >= 1960) for i in range(2000)])
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in texts])))
    t = toxicity.tokens(data, bounds)
    same = toxicity._distinct_texts(t.cells, t.first)
    assert len(set(same[1960:].tolist())) == 1 and len(set(same[:1960].tolist())) == 1960
    per = np.diff(t.first)
    y = toxicity._toxic_words(t.cells, np.repeat(labels == 1, per), np.repeat(same, per))
    words = [bytes(data[a:b]) for a, b in zip(t.start, t.end)]
    got = {w for w, toxic in zip(words, y) if toxic}
    assert got == {b"phrasal", b"you", b"any"} | {b"%02dtail" % i for i in range(66)}


def test_words_lose_all_outer_punctuation():
    """However many marks stand around a word, its features and bounds are those of the bare word."""
    text = b"idiot " + b"." * 9 + b"idiot " + b"*" * 500 + b"idiot" + b"!" * 40 + b" ------------ a"
    t = toxicity.tokens(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert [text[a:b] for a, b in zip(t.start, t.end)] == [b"idiot"] * 3 + [b"-" * 12, b"a"]
    assert (t.cells[:, :3] == t.cells[:, :1]).all()


def test_without_labels_or_with_one_class(spark, tables):
    docs = tables[0].limit(20)
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    one = spark.createDataFrame([(1, 1, 1), (2, None, None), (None, 0, 0), (3, 7, 7)], "doc_id long, toxic int, quality int")
    for labels in (none, one):
        assert toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).select("score").distinct().count() == 1
        assert quality.score_quality(docs, quality.fit_quality(docs, labels)).select("score").distinct().count() == 1
    model = toxicity.fit_toxicity(docs, one)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_indicators_are_distinct_and_whole():
    text = b"aab aab aab aab end"
    (cells,) = quality.Indicators()(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    grams = {text[i : i + n] for n in quality.NGRAMS for i in range(len(text) - n + 1)}
    assert len(set(cells.tolist())) == len(cells) and {2, 3, 4} <= set(cells.tolist()) and 5 not in cells
    assert len(cells) <= len(grams) + 3


def test_dual_descent_separates():
    rows = [np.array([1, 2, 3], np.int32), np.array([1, 4], np.int32), np.array([5, 2], np.int32), np.array([5, 4], np.int32)] * 5
    y = np.array([1.0, 1.0, -1.0, -1.0] * 5)
    scale = quality._ratios(rows, y)
    weights = quality._descend(rows, y, scale)
    assert all(np.sign(quality._margin(weights, scale, r)) == s for r, s in zip(rows, y))


def test_logistic_fit():
    g = np.random.default_rng(1)
    x = g.standard_normal(2000)
    y = (g.random(2000) < sigmoid(2 * x - 1)).astype(float)
    slope, constant = logistic_fit(x[:, None], y, np.ones(2000))
    assert abs(slope - 2) < 0.3 and abs(constant + 1) < 0.3
