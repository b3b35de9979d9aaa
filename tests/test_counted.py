"""Scores in chunks of tokens: beside plain sums."""

from __future__ import annotations

import random

import pytest

from warcloom.operators import classify, counted


@pytest.mark.parametrize("chunk", [1 << 21, 5])
def test_chunks_against_plain_sums(spark, monkeypatch, chunk):
    monkeypatch.setattr(counted, "CHUNK", chunk)
    chance = random.Random(3)
    words = [f"w{k}" for k in range(12)] + [None]
    texts = [(chance.choice([None, *range(9)]), [chance.choice(words) for _ in range(chance.randint(0, 9))]) for _ in range(40)]
    weights = {(c, w): chance.uniform(-1, 1) for c in "abc" for w in words[:9] if chance.random() < 0.6}
    bias = {"a": 0.5, "b": -0.5, "c": 0.0}
    want = {}
    for k, tokens in texts:
        for w in tokens:
            own = [c for c in bias if (c, w) in weights]
            for c in own:
                want[k, c] = want.get((k, c), bias[c]) + weights[c, w]
            if w and not own:
                want[k, None] = None
    frame = spark.createDataFrame(texts, "k int, tokens array<string>").repartition(3)
    model = spark.createDataFrame([(c, w, x) for (c, w), x in weights.items()], "class string, term string, weight double")
    found = classify.class_scores(frame, "k", "tokens", model, spark.createDataFrame([*bias.items()], "class string, bias double"))
    got = {(r.k, r["class"]): r.score for r in found.collect()}
    assert got.keys() == want.keys() and all(got[x] == y or abs(got[x] - y) < 1e-9 for x, y in want.items())
    assert "Generate explode(tokens" not in found._jdf.queryExecution().toString()
