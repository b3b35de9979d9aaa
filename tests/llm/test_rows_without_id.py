"""Many rows without doc_id: dealt like others, with the results of the plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_plain import awkward, near_classes, without_repeats, words
from pyspark.sql import functions as F

from warcloom.llm import op01_suffixes, op02_weighted_minhash, op03_cover, op04_hidden_markov, op10_latent_leaks, rounds


@pytest.fixture(scope="module")
def frame(spark):
    chance = random.Random(8)
    shared = [" ".join(f"s{k}w{chance.randrange(10**6)}" for _ in range(45)) for k in range(6)]
    rows = []
    for k in range(240):
        own = " ".join(f"o{k}x{chance.randrange(10**6)}" for _ in range(30))
        text = f"{own} {chance.choice(shared)} {own[:50]} {chance.choice(shared)}"
        rows.append((None if k % 3 else k - 100, text, "en"))
    rows += [(None, rows[1][1], "en")] * 40 + [(None, None, "en")] * 40 + [(-(1 << 63) + 1, rows[2][1], "en")]
    return awkward(spark, more=rows)


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_spread_over_parts(frame):
    rows, parts = rounds.keyed(frame)
    sizes = rows.where("doc_id IS NULL").distinct().groupBy("part").count().collect()
    assert len(sizes) == parts and max(r["count"] for r in sizes) < 60


def test_order_is_that_of_spark(frame):
    for r in frame.where("text IS NOT NULL").select("text", F.xxhash64("text").alias("hash")).collect():
        assert rounds.text_order(r.text.encode()) == r.hash


@pytest.mark.parametrize("hot", [op01_suffixes.HOT, 2])
def test_byte_repeats(frame, hot):
    found = [(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in op01_suffixes.remove_repeats(frame, hot).collect()]
    assert Counter(found) == Counter(without_repeats(pairs(frame), 100, lambda t: (t or "").encode(), bytes))


def test_word_repeats(frame):
    found = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in op03_cover.remove_repeats(frame).collect()]
    assert Counter(found) == Counter(without_repeats(pairs(frame), 20, words, b" ".join))


def test_one_of_each_class_and_all_without_id(frame):
    rows = pairs(frame)
    kept = op02_weighted_minhash.keep_one(frame)
    want = Counter(set(near_classes(rows).values())) + Counter([None for i, _ in rows if i is None])
    assert kept.columns == frame.columns and Counter(r.doc_id for r in kept.collect()) == want


def test_scores_do_not_depend_on_ids(frame):
    scored = op04_hidden_markov.score(frame).collect()
    assert len(scored) == frame.count() and all(np.isfinite(r.score) for r in scored)


def test_only_rows_with_a_leak_go(spark, frame):
    item = spark.createDataFrame([(1, " ".join(f"leak{k}" for k in range(30)))], "item_id long, text string")
    text = item.first().text
    leaky = frame.withColumn("text", F.when(F.col("doc_id").isNull() & F.col("text").startswith("o1"), F.concat("text", F.lit(" " + text))).otherwise(F.col("text")))
    left = op10_latent_leaks.without_leaks(leaky, item)
    want = [(i, t) for i, t in pairs(leaky) if text not in (t or "")]
    assert left.columns == frame.columns and Counter(pairs(left)) == Counter(want) and len(want) < frame.count()


def test_sums_of_many_tasks(spark):
    def ones(batches):
        n = sum(b.num_rows for b in batches)
        sums = [rounds.pack(np.array([n])), rounds.pack(np.array([2 * n]))]
        yield pa.record_batch([pa.array([0, 1], pa.int32()), pa.array(sums, pa.binary())], names=["block", "data"])

    made = spark.range(0, 3000, numPartitions=300).mapInArrow(ones, rounds.SUMS)
    assert {k: int(v[0][0]) for k, v in rounds.add_up(made).items()} == {0: 3000, 1: 6000}
