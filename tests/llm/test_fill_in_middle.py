"""Fill-in-middle outputs beside a version that works on one text at a time."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from llm_plain import awkward
from pyspark.sql import functions as F

from warcloom.llm import op13_fill_in_middle as op13

SF = "/root/testdata/sf0.001"


def plain(doc_id, text):
    text = text or ""
    n, h = len(text), hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, z = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", a, z - a, "<S>" + text[z:] + "<P>" + text[:a] + "<M>" + text[a:z]
    return n, "psm", a, z - a, "<P>" + text[:a] + "<S>" + text[z:] + "<M>" + text[a:z]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frames(spark):
    marks = ["a <P> b", "<S>", "x<M>y", "<", "<P", "ends with <", "\U0001f600" * 9000, "é" * 4096, "z" * 4097]
    yield awkward(spark, marks, [(7, "again", "en")] * 25 + [(None, "no id", "en")] * 25)
    yield spark.read.parquet(f"{SF}/documents.parquet")
    yield awkward(spark).limit(0)


@pytest.mark.parametrize("unit", [op13.UNIT, 3])
def test_digests(spark, unit):
    for frame in frames(spark):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        want = Counter()
        for doc_id, text in rows:
            n, form, prefix, middle, output = plain(doc_id, text)
            want[doc_id, n, form, prefix, middle, sha(output), sha(text or "")] += 1
        found = op13.digests(frame, unit=unit)
        assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
        assert Counter(map(tuple, found.collect())) == want


def test_texts_and_the_way_back(spark):
    for frame in frames(spark):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        made = op13.fill_in_middle(frame).withColumn("text", op13.restored_text("output", "form"))
        found = made.collect()
        assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found) == Counter((i, *plain(i, t)) for i, t in rows)
        assert Counter((r.doc_id, r.text) for r in found) == Counter((i, t or "") for i, t in rows)
        assert all(op13.restored(r.output, r.form) == r.text for r in found)


def test_forms_occur(spark):
    found = op13.digests(spark.read.parquet(f"{SF}/documents.parquet")).groupBy("form").count().collect()
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_texts_cross_the_network_once(spark):
    made = op13.digests(spark.read.parquet(f"{SF}/documents.parquet"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2


def test_a_hot_row_is_dealt_by_input_partition(spark):
    hot = spark.range(0, 6000, numPartitions=12).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same row").alias("text"))
    keys = op13.in_output_order(hot).groupBy("mark", "part").count().collect()
    assert len(keys) == 12
    assert op13.digests(hot).count() == 6000
