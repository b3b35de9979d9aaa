"""Edits beside full encoding, and their cost."""

from __future__ import annotations

import random
import time

import pytest
from llm_plain import awkward
from pyspark.sql import functions as F

from warcloom.llm import op08_edit_counts as op08

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counter():
    return op08.PieceCounter(*op08.default_vocabulary())


def plainly(text, edits):
    """The text after the edits, by slices from the last to the first."""
    limit = len(text)
    done = 0
    whole = text
    for start, end, new in sorted(edits, key=lambda e: (-e[0], -e[1])):
        start, end = max(start, 0), min(end, len(whole))
        if start <= end <= limit:
            text = text[:start] + new + text[end:]
            limit, done = start, done + 1
    return text, done


@pytest.mark.parametrize("leaves", [64, 2])
def test_sweep_against_full_encoding(counter, monkeypatch, leaves):
    monkeypatch.setattr(op08, "LEAVES", leaves)
    chance = random.Random(11)
    for turn in range(3000):
        letters = chance.choice(["ab  \n\n'st12.,#é ", "a'relvdmst ", "  \n\t a", "abc", "1 ,.!a"])
        text = "".join(chance.choice(letters) for _ in range(chance.randint(0, 200 if turn % 10 == 0 else 30)))
        edits = []
        for _ in range(chance.randint(0, 12)):
            a = chance.randint(-1, len(text) + 1)
            edits.append((a, a + chance.choice([0, 0, 1, 2, 9]), "".join(chance.choice(letters) for _ in range(chance.choice([0, 0, 1, 4, 30])))))
        done, before, after, counted = op08.edited(text, edits, counter)
        want, n = plainly(text, edits)
        assert counted.text == want and done == n
        assert before == len(counter.encoding.encode_ordinary(text)) and after == len(counter.encoding.encode_ordinary(want))
        pieces = counter.pattern.findall(want)
        assert counted.pieces == pieces and counted.size == len(pieces)
        counts = counter.counts(pieces)
        for leaf in {0, len(pieces) // 3, len(pieces)}:
            assert counted.tree.before(leaf) == sum(counts[:leaf])


@pytest.mark.parametrize("unit", ["word and ### more", "x", " ", "1###", "\n\n'"])
def test_time_is_linear(counter, unit):
    took = []
    for n in (20_000, 80_000):
        text = unit * (n * 8 // len(unit))
        edits = [(k * 8, k * 8 + 3, "[redacted]" if k % 2 else "") for k in range(n)]
        start = time.perf_counter()
        _, _, after, counted = op08.edited(text, edits, counter)
        took.append(time.perf_counter() - start)
        assert after == sum(counter.counts(counter.pattern.findall(counted.text)))
    assert took[1] < 20 * max(took[0], 0.1)


def test_query_rows_against_full_encoding(spark, counter):
    hard = ["card 4111111111111111 and ####", "token = abcdefabcdefabcdef12", "###" * 5000, "a### " * 5000, "#" * 30_000]
    for frame in (awkward(spark, hard), spark.read.parquet(f"{SF}/documents.parquet"), awkward(spark).limit(0)):
        found = sorted(((r.doc_id, r.n_edits, r.tokens_before, r.tokens_after, r.pretokens_after) for r in op08.count_edits(frame).collect()), key=str)
        want = []
        for r in frame.collect():
            text = r.text or ""
            after, n = plainly(text, op08.redactions(text))
            sizes = [len(counter.encoding.encode_ordinary(x)) for x in (text, after)]
            want.append((r.doc_id, n, *sizes, len(counter.pattern.findall(after))))
        assert found == sorted(want, key=str)


def test_edits_of_a_column(spark, counter):
    frame = awkward(spark).withColumn("edits", F.expr("array(named_struct('start', 2, 'end', 5, 'replacement', 'new '), null, named_struct('start', 0, 'end', 0, 'replacement', ' x'))"))
    for r in op08.count_edits(frame, "edits").collect():
        assert r.pretokens_encoded <= r.pretokens_after + 4
        assert r.n_edits >= 1


def test_known_pieces_are_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(op08, "CACHED_BYTES", 2000)
    small = op08.PieceCounter(*op08.default_vocabulary())
    assert small.count("x" * 5000) > 0 and not small.known
    assert [small.count(f"w{k}") for k in range(100)] and 0 < len(small.known) <= 12
