"""The pipeline's stages, one by one, and the run as a whole."""

from __future__ import annotations

from collections import Counter

import pyarrow.parquet as pq
from llm_plain import awkward, near_classes
from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    items = pq.read_table(f"{SF}/benchmark.parquet")["text"].to_pylist()
    before = {r.doc_id: r.text for r in rows.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, rows, SF)
        assert made.columns == rows.columns, name
        made = spark.createDataFrame(made.collect(), made.schema)
        after = {r.doc_id: r.text for r in made.collect()}
        if name == "near_duplicates":
            assert set(after) == set(near_classes(list(before.items())).values())
        if name == "benchmark_leaks":
            assert set(after) == {k for k, text in before.items() if not any(x in text for x in items)}
        if name == "secrets":
            assert set(after) == set(before) and sum(after[k] != before[k] for k in after) > 0
        rows, before = made, after
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
    assert {r.doc_id for r in packed.collect()} == set(before)
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def clashing(frame):
    return frame.withColumns({c: F.lit("x") for c in ("kept_id", "row_of_id", "leaked_id", "class_id", "label", "item_id")})


def test_stages_on_awkward_documents(spark):
    """Nulls in every column, repeated and long rows, names that clash: what goes is what the stage's own rule says."""
    item = pq.read_table(f"{SF}/benchmark.parquet")["text"][0].as_py()
    frame = clashing(awkward(spark, [f"lead {item} end", "api_key = q8Zt3LwX0vB5nR7yKd2MpA9s"], [(None, item, "en"), (300, None, None)]))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    made = {name: stage(spark, frame, SF) for name, stage in corpus_pipeline.STAGES}
    assert all(made[name].schema == frame.schema for name, _ in corpus_pipeline.STAGES[:-1])
    got = {name: Counter((r.doc_id, r.text) for r in made[name].collect()) for name, _ in corpus_pipeline.STAGES[:-1]}
    assert got["language"] == Counter(r for r in rows if any(c.isalpha() for c in r[1] or ""))
    assert Counter(i for i, _ in got["near_duplicates"].elements()) == Counter(set(near_classes(rows).values())) + Counter(i for i, _ in rows if i is None)
    assert got["benchmark_leaks"] == Counter(r for r in rows if item not in (r[1] or ""))
    assert Counter(i for i, _ in got["secrets"].elements()) == Counter(i for i, _ in rows)
    assert sum(n for (_, t), n in got["secrets"].items() if "[redacted]" in (t or "")) == 1
    packed = made["packing"].collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(i for i, _ in rows)


def test_stages_on_empty_tables(spark):
    none = clashing(awkward(spark)).where("false")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, none, SF)
        assert made.count() == 0 and (name == "packing" or made.schema == none.schema)
