"""Block-Max MaxScore beside scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_plain import awkward

from warcloom.llm import op11_block_max as op11

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(rows, items, top=50):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, own, sum(own.values())) for i, own in docs if own]
    big, total = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, own, _ in docs for t in own)
    out = []
    for item_id, text in items:
        wanted = set(terms(text))
        found = []
        for doc_id, own, n in docs:
            m = 100 - 50 + (50 * n * big) // total
            score = sum(math.floor(1000 * math.log((2 * big + 2) / (2 * df[t] + 1))) * ((1000000000 * own[t]) // (1000 * own[t] + 20 * m)) for t in wanted if t in own)
            if score > 0:
                found.append((score, doc_id))
        found.sort(key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
        out += [(item_id, k, doc_id, score) for k, (score, doc_id) in enumerate(found[:top], 1)]
    return Counter(out)


def of(frame, *names):
    return [tuple(r) for r in frame.select(*names).collect()]


@pytest.mark.parametrize("small", [False, True])
def test_ranks(spark, monkeypatch, small):
    if small:  # many shards, blocks and blocks of items
        for name, value in {"SHARD_BYTES": 20_000, "SHARD_ROWS": 7, "BLOCK": 3, "ITEM_TERMS": 40, "SEEDS": 3}.items():
            monkeypatch.setattr(op11, name, value)
    items = spark.createDataFrame(
        [(1, "alpha1 beta2 word5 ONE", 3, "x"), (2, None, 4, "x"), (3, "...", 5, "x"), (3, "one two", 6, "x"), (None, "École 中文 12", 7, "x"), (4, "nowhere", 8, "x"), (4, "one two", 9, "x")],
        "item_id long, text string, score int, rank string",
    )
    ties = [f"tie {k % 3} same words here" for k in range(130)]
    docs = awkward(spark, ties + ["one"] * 70, [(5, "one", "en")] * 60)
    tied = spark.createDataFrame([(9, "same words")], "item_id long, text string")
    for frame, wanted in ((docs, items), (docs, tied), (docs.limit(0), items), (docs, items.limit(0))):
        found = op11.rank_documents(frame, wanted)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(map(tuple, found.collect())) == ranked(of(frame, "doc_id", "text"), of(wanted, "item_id", "text"))


def test_ranks_of_given_tables(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "benchmark"))
    want = ranked(of(docs, "doc_id", "text"), of(items, "item_id", "text"))
    assert Counter(map(tuple, op11.rank_documents(docs, items).collect())) == want
    monkeypatch.setattr(op11, "SHARD_ROWS", 16)
    monkeypatch.setattr(op11, "SEEDS", 4)
    assert Counter(map(tuple, op11.rank_documents(docs, items).collect())) == want


def postings(docs, tfs, norm):
    doc, tf = np.array(docs), np.array(tfs)
    data, at = op11._packed(doc, tf, op11._impacts(tf, norm[doc]), np.array([0]))
    return op11.Postings(len(doc), data[at[0] : at[1]].tobytes(), norm)


def test_blocks_come_back():
    chance = random.Random(3)
    for _ in range(200):
        n = chance.randint(1, 700)
        docs = sorted(chance.sample(range(1 << 15), n))
        tfs = [chance.choice([1, 1, 1, 2, 300, 1 << 33]) if chance.random() < 0.1 else 1 for _ in docs]
        norm = np.array([chance.randint(50, 900) for _ in range(1 << 15)])
        made = postings(docs, tfs, norm)
        doc, impact = made.whole()
        assert doc.tolist() == docs
        assert impact.tolist() == [1000000000 * t // (1000 * t + 20 * int(norm[d])) for d, t in zip(docs, tfs, strict=True)]
        assert made.most.tolist() == [int(impact[k : k + op11.BLOCK].max()) for k in range(0, n, op11.BLOCK)]


def test_rejected_blocks_are_not_read():
    norm = np.full(4000, 100)
    rare, common = postings(list(range(60)), [9] * 60, norm), postings(list(range(4000)), [1] * 4000, norm)
    lists = [(rare, 1000, 1000 * int(rare.most.max())), (common, 10, 10 * int(common.most.max()))]
    doc, _ = op11.search_shard(lists, 4000, 50, 0)
    assert doc.tolist() == list(range(50))
    assert len(common.read) == 1 and len(common.count) == 32


def test_search_sends_postings_of_the_items_only(spark):
    docs, items = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "benchmark"))
    size = op11.corpus_size(docs)
    index = op11.build_index(docs, size)
    assert index.where("n > 0").agg({"n": "sum"}).first()[0] == sum(len(set(terms(t))) for _, t in of(docs, "doc_id", "text"))
    one = op11.search(index, size, items.limit(1)).collect()
    assert 0 < len(one) <= 50
