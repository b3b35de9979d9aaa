"""Models above the bound: beside the same in the row and in SQL."""

from __future__ import annotations

import duckdb
import pytest
from oracle_check import TABLES, compare
from pyspark.sql import functions as F

from warcloom.operators import linear
from warcloom.plans import steps


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Tables of the schema of sf0.001, with the few rows that queries on topics need."""
    at = str(tmp_path_factory.mktemp("small"))
    source = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"COPY (SELECT * FROM '{source}/{name}.parquet') TO '{at}/{name}.parquet' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet'")
    return at, connection


def test_a_model_above_the_bound_is_joined(spark, small, monkeypatch):
    at, connection = small
    monkeypatch.setattr(linear, "MODEL_BYTES", 1000)
    assert compare(spark, connection, "algseq_topics", at) is None


def test_stored_models_score_as_collected_ones(spark):
    model = spark.createDataFrame([("sport", "goal", 2.0), ("war", "goal", -3.0), ("sport", "ball", 0.25), ("odd", "ball", 1.0)], "class string, term string, weight double")
    bias = spark.createDataFrame([("sport", -1.0), ("war", 0.5), ("news", 0.1)], "class string, bias double")
    rows = spark.createDataFrame(
        [(1, "goal ball", "cs", False), (1, "goal ball", "cs", False), (None, "ball", "cs", False), (2, "goal", "en", False), (3, "", "cs", False), (4, "goal", "cs", True), (5, None, "cs", False), (6, "x", "cs", False)],
        "k int, plain_text string, language string, is_revisit boolean",
    ).withColumn("mime_group", F.lit("HTML"))
    both = []
    for limit in (None, 10):
        known = linear.usable_model(model, bias, limit)
        assert isinstance(known, linear.LinearModel if limit is None else linear.StoredModel)
        found = steps.run_steps(rows, {"HTML": [steps.word_tokens(), steps.topics(known)]})
        both.append(sorted(map(str, found.select(sorted(found.columns)).collect())))
    assert both[0] == both[1] and len(both[0]) == 8


@pytest.mark.parametrize("limit", [None, 10])
def test_labels_without_a_class_have_no_score(spark, limit):
    model = spark.createDataFrame([("sport", "goal", 2.0)], "class string, term string, weight double")
    bias = spark.createDataFrame([("sport", -1.0), (None, 5.0)], "class string, bias double")
    known = linear.usable_model(model, bias, limit)
    rows = spark.createDataFrame([("goal", "cs", "HTML", False)], "plain_text string, language string, mime_group string, is_revisit boolean")
    assert steps.run_steps(rows, {"HTML": [steps.topics(known)]}).first()["topics"] == ["sport"]
