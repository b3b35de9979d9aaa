"""Steps that score and steps that fail: beside plain versions."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from warcloom.operators import classify, linear, registry
from warcloom.plans import steps

SF = "/root/testdata/sf0.001"


def model_tables(spark):
    model = spark.createDataFrame(
        [("sport", "goal", 2.0), ("war", "goal", -3.0), ("sport", "ball", 0.25), ("sport", "ball", 0.25), ("war", None, 1.0)],
        "class string, term string, weight double",
    )
    return model, spark.createDataFrame([("sport", -1.0), ("war", 0.5), ("news", 0.1)], "class string, bias double")


def token_rows(spark):
    rows = [(1, ["goal", "goal"]), (2, ["other"]), (3, ["ball", "ball", None, "ball"]), (4, []), (5, None), (6, ["goal"] * 5000)]
    return spark.createDataFrame(rows, "k int, tokens array<string>")


@pytest.mark.parametrize("chunk", [1 << 21, 3])
def test_topics_within_the_row(spark, monkeypatch, chunk):
    monkeypatch.setattr(linear, "_CHUNK", chunk)
    model, bias = model_tables(spark)
    found = linear.collect_model(model, bias)
    texts = token_rows(spark)
    rows = texts.select("k", linear.topics_of(spark, found)(F.col("tokens")).alias("topics"))
    assert dict(map(tuple, rows.collect())) == {1: ["news", "sport"], 2: ["news", "war"], 3: ["news", "sport", "war"], 4: None, 5: None, 6: ["news", "sport"]}
    # the join gives the same
    joined = classify.topics(classify.class_scores(texts, "k", "tokens", model, bias), "k", bias)
    want = {k: v for k, v in dict(map(tuple, rows.collect())).items() if v is not None}
    assert dict(map(tuple, joined.collect())) == want
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_sentiment_within_the_row(spark):
    model = spark.createDataFrame([("positive", "dobrý", 1.5), ("negative", "hnus", 900.0)], "class string, term string, weight double")
    bias = spark.createDataFrame([("positive", 0.2), ("negative", -0.1)], "class string, bias double")
    found = linear.collect_model(model, bias)
    texts = spark.createDataFrame([(1, ["dobrý"]), (2, ["hnus"]), (3, [])], "k int, t array<string>")
    rows = dict(map(tuple, texts.select("k", linear.sentiment_of(spark, found)(F.col("t"))).collect()))
    p, n = math.exp(1.7), math.exp(-0.1)
    assert abs(rows[1] - (p - n) / (p + n)) < 1e-12 and rows[2] == -1.0 and rows[3] is None
    with pytest.raises(ValueError):
        linear.sentiment_of(spark, found, "good")


def test_model_size_is_checked(spark):
    with pytest.raises(ValueError, match="bytes"):
        linear.collect_model(*model_tables(spark), limit=50)
    empty = linear.collect_model(*(t.limit(0) for t in model_tables(spark)))
    rows = token_rows(spark).select(linear.topics_of(spark, empty)(F.col("tokens")).alias("t")).collect()
    assert [r.t for r in rows] == [[], [], [], None, None, []]


def test_steps_in_a_sequence(spark):
    model, bias = model_tables(spark)
    known = linear.collect_model(model, bias)
    mood = linear.collect_model(
        spark.createDataFrame([("positive", "goal", 1.0)], "class string, term string, weight double"),
        spark.createDataFrame([("positive", 0.0), ("negative", 0.0)], "class string, bias double"),
    )
    rows = spark.createDataFrame(
        [(1, "goal ball", "cs", False), (2, "goal", "en", False), (3, "", "cs", False), (4, "goal", "cs", True), (5, None, "cs", False)],
        "k int, plain_text string, language string, is_revisit boolean",
    ).withColumn("mime_group", F.lit("HTML"))
    for tokens in ([], [steps.word_tokens()]):
        done = steps.run_steps(rows, {"HTML": [*tokens, steps.topics(known), steps.sentiment(mood)]})
        assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()
        found = {r.k: (r.topics, r.sentiment) for r in done.collect()}
        assert found == {1: (["news", "sport"], math.tanh(0.5)), 2: (None, None), 3: (None, None), 4: (None, None), 5: (None, None)}


def corpus(n=240):
    chance = random.Random(7)
    words = {"a": ["apple", "pear", "plum"], "b": ["bolt", "nut", "gear"], "c": ["cat", "dog"]}
    texts, labels = [], []
    for k in range(n):
        own = [c for c in words if chance.random() < 0.4]
        tokens = [chance.choice(words[c]) for c in own for _ in range(chance.randint(1, 4))] + [f"noise{chance.randint(0, 25)}" for _ in range(6)]
        texts.append((k, tokens, "x"))
        labels += [(k, c) for c in own]
    return texts, labels + [(3, None), (9999, "a")]


def plain_svm(texts, labels, regularisation, min_texts):
    """Vectors by dictionaries, one machine per class by many steps of gradient descent on a smoothed objective."""
    have = {}
    for k, c in labels:
        if c:
            have.setdefault(k, set()).add(c)
    rows = [(t, have[k]) for k, t, _ in texts if k in have and t]
    df = Counter(w for t, _ in rows for w in set(t))
    vocabulary = sorted(w for w, n in df.items() if n >= min_texts)
    idf = {w: math.log((len(rows) + 1) / (df[w] + 1)) for w in vocabulary}
    x = np.zeros((len(rows), len(vocabulary)))
    for r, (t, _) in enumerate(rows):
        for w, n in Counter(t).items():
            if w in idf:
                x[r, vocabulary.index(w)] = n * idf[w]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)

    def loss(w, b, y):
        return np.maximum(0, 1 - y * (x @ w + b)).mean() + regularisation / 2 * (w @ w)

    out = {}
    for c in sorted({c for own in have.values() for c in own}):
        y = np.array([1.0 if c in own else -1.0 for _, own in rows])
        w, b, best = np.zeros(len(vocabulary)), 0.0, None
        for step in range(1, 6001):
            hit = y * (x @ w + b) < 1
            w = w - 2 / (1 + step * regularisation * 2) * (regularisation * w - (y * hit) @ x / len(y))
            b = b + 2 / (1 + step * regularisation * 2) * (y * hit).mean()
            if step % 50 == 0 and (best is None or loss(w, b, y) < best[0]):
                best = loss(w, b, y), w.copy(), b
        out[c] = best
    return rows, vocabulary, idf, x, out, loss


def test_machines_against_plain_version(spark):
    texts, labels = corpus()
    frame = spark.createDataFrame([*texts, (10_000, None, "x"), (10_001, [], "x")], "k int, tokens array<string>, weight string").repartition(4)
    taught = spark.createDataFrame([*labels, (10_000, "a"), (10_001, "a")], "k int, class string")
    model, bias, idf = linear.fit_svm(frame, "k", "tokens", taught, regularisation=0.01)
    rows, vocabulary, plain_idf, x, plain, loss = plain_svm(texts, labels, 0.01, 2)
    got_idf = {r.term: r.idf for r in idf.collect()}
    assert set(got_idf) == set(vocabulary) and all(abs(got_idf[w] - plain_idf[w]) < 1e-9 for w in vocabulary)
    weights = {(r["class"], r["term"]): r["weight"] for r in model.collect()}
    biases = {r["class"]: r["bias"] for r in bias.collect()}
    assert sorted(biases) == ["a", "b", "c"]
    known = linear.collect_model(model, bias, idf)
    for c, (least, w, b) in plain.items():
        y = np.array([1.0 if c in own else -1.0 for _, own in rows])
        own = np.array([weights.get((c, t), 0.0) / plain_idf[t] if plain_idf[t] else 0.0 for t in vocabulary])
        assert loss(own, biases[c], y) <= least * 1.01
        assert np.mean((x @ own + biases[c] > 0) == (x @ w + b > 0)) > 0.97
        import pyarrow as pa

        scores = known.scores(pa.array([t for t, _ in rows], pa.list_(pa.string())))[:, known.classes.index(c)]
        assert np.allclose(scores, x @ own + biases[c])


def test_machines_without_labels(spark):
    frame = token_rows(spark)
    made = linear.fit_svm(frame, "k", "tokens", spark.createDataFrame([], "k int, class string"))
    assert [t.count() for t in made] == [0, 0, 0]


# Steps that raise


def pages(spark, n=1000):
    rows = spark.range(0, n, numPartitions=3).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("id"), F.concat(F.lit("http://h/"), F.col("id")).alias("url"), F.lit("HTML").alias("mime_group"),
        (F.col("id") % 10 == 0).alias("is_revisit"), F.array(F.lit("harmless")).alias("errors"), F.col("id").alias("n"),
    )
    return rows.withColumn("note", F.lit("before"))


def raising():
    def function(batch):
        if (batch["n"] % 97 == 5).any():
            raise ValueError("page of ninety-seven")
        return batch.assign(note=batch["n"].astype(str), size=batch["url"].str.len())

    return function


def test_only_failing_rows_fail(spark):
    step = steps.python_step("mine", raising(), {"note": "string", "size": "bigint"}, ["n", "url"])
    done = {r.id: r for r in steps.run_steps(pages(spark), {"HTML": [step]}).collect()}
    for k in range(1000):
        row = done[f"u{k}"]
        if k % 10 == 0:
            assert (row.note, row.size, row.errors) == ("before", None, ["harmless"])
        elif k % 97 == 5:
            assert (row.note, row.size) == ("before", None)
            assert row.errors == ["harmless", "step mine: ValueError: page of ninety-seven"]
        else:
            assert (row.note, row.size, row.errors) == (str(k), len(f"http://h/{k}"), ["harmless"])
    assert done["u5"].url == "http://h/5"  # inputs stay


@pytest.mark.parametrize("bad", [lambda b: b.head(0), lambda b: b[["n"]], lambda b: b.assign(size="no number"), lambda b: 1 / 0])
def test_wrong_results_are_failures(spark, bad):
    step = steps.python_step("bad", bad, {"size": "bigint"}, ["n"])
    done = steps.run_steps(pages(spark, 40).drop("errors"), {"HTML": [step]})
    assert done.filter(steps.failed_steps(done)).count() == 36 and done.filter("size IS NOT NULL").isEmpty()
    again = steps.run_steps(done, {"HTML": [steps.python_step("good", lambda b: b.assign(size=b["n"]), {"size": "bigint"}, ["n"])]})
    assert again.filter("size = n").count() == 36 and all(len(r.errors) == 1 for r in again.collect() if r.errors)


def test_failed_rows_are_counted(spark):
    step = steps.python_step("mine", raising(), {"size": "bigint"}, ["n", "url"])
    done = steps.run_steps(pages(spark), {"HTML": [step]}).withColumns({"drop_reason": F.lit(None).cast("string"), "harvest_id": F.lit("h")})
    row = registry.run_counts(done, steps.failed_steps(done)).first()
    failed = sum(k % 97 == 5 and k % 10 != 0 for k in range(1000))
    assert (row["records_processed"], row["records_failed"]) == (1000 - failed, failed)


def test_few_calls_for_few_failures(spark):
    calls, one = spark.sparkContext.accumulator(0), raising()

    def counting(batch):
        calls.add(1)
        return one(batch).assign(size=1)

    step = steps.python_step("mine", counting, {"size": "bigint"}, ["n", "url"])
    steps.run_steps(pages(spark, 1000).coalesce(1), {"HTML": [step]}).write.format("noop").mode("overwrite").save()
    failing = sum(k % 97 == 5 and k % 10 != 0 for k in range(1000))
    assert failing < calls.value <= 2 * failing * 11


def test_texts_are_joined_before_they_are_tokenised(spark, monkeypatch):
    plans, store = [], linear.stored
    monkeypatch.setattr(linear, "stored", lambda rows, purpose: (plans.append((purpose, rows._jdf.queryExecution().optimizedPlan().toString())), store(rows, purpose))[1])
    texts = spark.createDataFrame([(k, f"a b{k % 3}") for k in range(12)], "k int, text string")
    labels = spark.createDataFrame([(k, "x" if k % 2 else "y") for k in range(12)], "k int, class string")
    linear.fit_svm(texts, "k", F.split("text", " "), labels, iterations=2)
    assert [x for x, _ in plans] == ["labelled", "counts", "vectors"]
    plan = plans[0][1]
    assert plan.count("split(") == 1 and plan.index("split(") < plan.index("Join")
