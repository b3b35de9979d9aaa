"""Scores of chunks: rows, row groups and workers' arrays of bounded size, with the same sums."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from warcloom.operators import classify, counted


@pytest.mark.parametrize("of_key", ["int", "string", "struct<a:int,b:string>"])
def test_stored_rows_and_row_groups_are_small(spark, monkeypatch, of_key):
    made, store = [], counted.stored
    monkeypatch.setattr(counted, "PIECE", 50)
    monkeypatch.setattr(counted, "_GROUP_BYTES", 4000)

    def kept(rows, purpose, *more):
        made.append((purpose, store(rows, purpose, *more)))
        return made[-1][1]

    monkeypatch.setattr(counted, "stored", kept)
    chance = random.Random(5)
    keyed = {"int": lambda k: k, "string": str, "struct<a:int,b:string>": lambda k: (k, str(k))}[of_key]
    texts = [(keyed(k % 70) if k % 9 else None, [chance.choice([None, *(f"w{i}" for i in range(300))]) for _ in range(chance.choice([0, 3, 20, 400]))]) for k in range(90)]
    texts += [(keyed(1), None), (keyed(2), [None, None]), (keyed(3), ["never"])]
    weights = {(c, f"w{i}"): chance.uniform(-1, 1) for c in "ab" for i in range(200) if chance.random() < 0.7} | {("", "w7"): 2.0}
    bias = {"a": 0.5, "b": -0.5, "": 0.0}
    want = {}
    for k, tokens in texts:
        for w in tokens or []:
            own = [c for c in bias if (c, w) in weights]
            for c in own:
                want[k, c] = want.get((k, c), bias[c]) + weights[c, w]
            if w and not own:
                want[k, None] = None
    frame = spark.createDataFrame(texts, f"k {of_key}, tokens array<string>").coalesce(1)
    model = spark.createDataFrame([(c, w, x) for (c, w), x in weights.items()], "class string, term string, weight double")
    found = classify.class_scores(frame, "k", "tokens", model, spark.createDataFrame([*bias.items()], "class string, bias double")).collect()
    got = {((tuple(r.k) if isinstance(r.k, tuple) else r.k), r["class"]): r.score for r in found}
    assert len(found) == len(got) and got.keys() == want.keys()
    assert all(got[x] == y or abs(got[x] - y) < 1e-9 for x, y in want.items())
    (parts,) = [x for purpose, x in made if purpose == "texts"]
    assert parts.selectExpr("max(coalesce(size(terms), 0))", "max(length(term)) / 4").first()[:] == (50, 50)
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in parts.inputFiles()]
    groups = [f.metadata.row_group(k) for f in files for k in range(f.metadata.num_row_groups)]
    assert len(groups) > 10 and max(g.num_rows for g in groups) < 30


def traced(made) -> float:
    tracemalloc.start()
    made()
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return most


def test_workers_hold_a_piece_of_a_chunk():
    chance = np.random.default_rng(2)
    drawn = np.minimum(chance.zipf(1.3, 2_000_000), 60_000) - 1
    words = pa.array([f"w{k}" for k in range(60_000)])
    tokens = pa.ListArray.from_arrays(pa.array(np.arange(0, 2_000_001, 250), pa.int32()), words.take(pa.array(drawn)))
    terms, cells = counted.counted(tokens)
    total = 0

    def count():
        nonlocal total
        total = sum(int(n.sum()) for _, n in cells)

    assert traced(count) < 40 and total == 2_000_000  # 83 with whole chunks

    rows = []
    for cell, tf in counted.counted(tokens)[1]:
        row, term = np.divmod(cell, len(terms))
        low, high = int(row[0]), int(row[-1]) + 1
        rows.append((list(range(low, high)), len(terms), *(counted._packed(x) for x in (np.bincount(row - low), term, tf))))
    kinds = {"keys": pa.list_(pa.int64()), "size": pa.int32(), "counts": pa.binary(), "term": pa.binary(), "tf": pa.binary()}
    part = pa.table({c: pa.array([r[k] for r in rows], kind) for k, (c, kind) in enumerate(kinds.items())})
    classes = pa.array([f"c{k % 12}" for k in range(12 * len(terms))])
    offsets = pa.array(np.arange(0, 12 * len(terms) + 1, 12), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, x) for x in (classes, pa.array(np.ones(12 * len(terms))))]
    found = pa.table([pa.array(np.arange(len(terms)), pa.int32()), *lists], names=["at", "classes", "weights"])
    sums = []
    assert traced(lambda: sums.append(counted._scorer("k")(part, found))) < 80  # 160 with whole chunks
    by_text = sums[0].group_by(["k", "class"]).aggregate([("total", "sum")])
    assert by_text.num_rows == 8000 * 12 and set(by_text["total_sum"].to_pylist()) == {250.0}
