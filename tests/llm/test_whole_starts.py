"""Trained starts and kept rows that depend on all texts."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from warcloom.llm import op04_hidden_markov as op04
from warcloom.llm import op06_language, rounds


def encoded(spark, texts, parts):
    """Rows as `score` encodes them: each text with the number of its training rows."""
    blobs = []
    for own in np.array_split(np.arange(len(texts)), parts):
        counts = np.array([len(texts[k][0]) for k in own])
        symbols = np.concatenate([texts[k][0] for k in own]).astype(np.uint16)
        none = np.zeros(len(own))
        blobs.append((rounds.pack(none, none, none, none, np.array([texts[k][1] for k in own]), counts, none, none, none, symbols),))
    return spark.createDataFrame([(bytes(x[0]),) for x in blobs], "data binary").repartition(3)


def test_the_first_chain_counts_every_training_text(spark):
    chance = np.random.default_rng(5)
    texts = [(chance.integers(20 * (k % 8), 20 * (k % 8) + 20, size=int(chance.integers(1, 30))), int(chance.integers(0, 3))) for k in range(5000)]
    counts = np.zeros(op04.SYMBOLS)
    for symbols, weight in texts:
        np.add.at(counts, symbols, weight)
        counts[op04.END] += weight
    ends = int(counts[op04.END])
    top = np.arange(op04.TOP, dtype=np.uint64)
    words = op04._Vocabulary(top, counts[: op04.TOP].astype(int), np.zeros(op04.CLASSES, int), np.zeros(op04.CLASSES, int), int(counts.sum()), 160, ends)
    seen = {}
    of_counts = op04.Chain.of_counts
    try:
        op04.Chain.of_counts = classmethod(lambda cls, *x: (seen.update(start=x[0], emit=x[2]), of_counts(*x))[1])
        op04._first_chain(encoded(spark, texts, 7), words)
    finally:
        op04.Chain.of_counts = of_counts
    assert np.allclose(seen["emit"].sum(axis=1), counts) and np.isclose(seen["start"].sum(), ends)


def test_texts_of_no_likely_language_go(spark, monkeypatch):
    frame = spark.createDataFrame([(1, "sure"), (2, "torn"), (3, "0")], "doc_id long, text string")

    class Known(op06_language.Model):
        def predict(self, texts):
            return [{"sure": ("en", 0.9), "torn": ("en", 0.4), "0": ("und", 0.0)}[x] for x in texts]

    monkeypatch.setattr(op06_language, "train", lambda docs: None)
    kept = []
    monkeypatch.setattr(corpus_pipeline, "keep_known", lambda docs, least=0.0: kept.append(least) or docs)
    corpus_pipeline.identify_language(spark, frame, "")
    assert kept == [corpus_pipeline.LEAST] and 0 < corpus_pipeline.LEAST <= 0.5
    found = Known([], np.zeros((1, 0)), np.zeros(0)).predict(["sure", "torn", "0"])
    assert [lang != op06_language.UNKNOWN and score >= corpus_pipeline.LEAST for lang, score in found] == [True, False, False]
