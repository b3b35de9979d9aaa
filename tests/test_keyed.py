"""Keyed tables: puts, versions, retries, writers at the same time."""

from __future__ import annotations

import gzip
import os

import pytest
from pyspark.sql import functions as F
from test_runs import PAGE, archive, sequences  # noqa: F401
from test_warc import record

from warcloom.plans import steps
from warcloom.plans.run import reprocess_table, save_run
from warcloom.sources import keyed
from warcloom.sources.keyed import KeyedTable, TakenError
from warcloom.streaming.incremental import save_new_files


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def puts(spark, data, columns="key string, a string, b string"):
    return spark.createDataFrame(data, columns)


@pytest.fixture()
def table(spark, tmp_path):
    return KeyedTable.create(spark, str(tmp_path / "t"), "key string, a string, b string", buckets=4)


def test_puts_replace_cells(spark, table):
    assert rows(table.read()) == [] and rows(table.get("x")) == []
    table.upsert(puts(spark, [("x", "1", "one"), ("y", "2", None), (None, "lost", None)]))
    table.upsert(puts(spark, [("x", None, "two"), ("z", "3", None)]))
    assert rows(table.read()) == [("x", "1", "two"), ("y", "2", None), ("z", "3", None)]
    assert rows(table.get("x")) == [("x", "1", "two")] and rows(table.get("none")) == []
    assert rows(table.read(1)) == [("x", "1", "one"), ("y", "2", None)]  # readers of a version keep it
    versioned = spark.createDataFrame([("x", "old", 1), ("x", "new", 2), ("x", None, 3)], "key string, a string, v int")
    assert table.upsert(versioned, version="v").schema.names == ["key", "a", "b"]
    assert rows(table.get("x")) == [("x", "new", "two")]


def test_new_columns_and_other_types(spark, table):
    table.upsert(puts(spark, [("x", "1", None)]))
    table.upsert(spark.createDataFrame([("y", 7, ["l"])], "key string, n long, c array<string>"))
    assert table.read().columns == ["key", "a", "b", "n", "c"]
    assert rows(table.read()) == [("x", "1", None, None, None), ("y", None, None, 7, ["l"])]
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([("y", 7)], "key string, a long"))
    assert KeyedTable.create(spark, table.root, "key string").manifest().version == 2  # opened as it is


def test_only_touched_buckets_are_written(spark, table):
    first = table.upsert(puts(spark, [(f"k{i}", str(i), None) for i in range(100)]))
    assert sorted(first.folders) == [0, 1, 2, 3]
    second = table.upsert(puts(spark, [("k1", "new", None)]))
    changed = {b for b in range(4) if first.folders[b] != second.folders[b]}
    assert len(changed) == 1
    found = table.get("k1")
    assert {os.path.basename(os.path.dirname(f)) for f in found.inputFiles()} == {f"bucket={b}" for b in changed}
    assert "EqualTo(key,k1)" in found._jdf.queryExecution().executedPlan().toString()
    assert table.read().count() == 100


def test_one_shuffle_of_stored_rows(spark, table, monkeypatch):
    many = puts(spark, [(f"k{i}", "1", None) for i in range(50)])
    table.upsert(many)
    plans = []
    writer = type(table.read().write)
    monkeypatch.setattr(writer, "parquet", lambda self, path, *a, **b: plans.append(self._df._jdf.queryExecution().executedPlan().toString()))
    table._with_puts(table.manifest(), many)
    assert plans[0].count("Exchange hashpartitioning(bucket") == 1 and plans[0].count("Exchange") == 1


def test_a_batch_counts_once(spark, table):
    batch = puts(spark, [("x", "1", None)])
    assert table.upsert(batch, batch_of=("stream", 5)).version == 1
    table.upsert(puts(spark, [("x", "later", None)]), batch_of=("other", 0))
    assert table.upsert(batch, batch_of=("stream", 5)).version == 2  # nothing happened
    assert rows(table.get("x")) == [("x", "later", None)]
    assert table.upsert(batch, batch_of=("stream", 6)).batches == {"stream": 6, "other": 0}


def test_a_killed_batch_leaves_no_trace(spark, table, monkeypatch):
    table.upsert(puts(spark, [("x", "1", None)]))

    def killed(self, made):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(puts(spark, [("x", "2", None)]), batch_of=("s", 1))
    assert rows(table.read()) == [("x", "1", None)]
    table.upsert(puts(spark, [("x", "2", None)]), batch_of=("s", 1))
    assert rows(table.read()) == [("x", "2", None)]
    assert table.vacuum(keep=1) == 2  # the killed batch's folder and the first one
    assert rows(table.read()) == [("x", "2", None)]
    with pytest.raises(Exception):
        table.read(1).collect()


def test_two_writers(spark, table, monkeypatch):
    publish, meant = KeyedTable._publish, []

    def raced(self, made):
        if not meant:  # while the first batch is written, another one is published
            meant.append(1)
            table.upsert(puts(spark, [("x", None, "theirs")]))
        publish(self, made)

    monkeypatch.setattr(KeyedTable, "_publish", raced)
    assert table.upsert(puts(spark, [("x", "mine", None)])).version == 2
    assert rows(table.read()) == [("x", "mine", "theirs")]
    with pytest.raises(TakenError):
        publish(table, table.manifest())


def test_a_hot_key_is_combined_before_it_is_dealt(spark, table):
    hot = spark.range(0, 20_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").cast("string").alias("a"), "id"
    )
    table.upsert(hot, version="id")
    assert rows(table.get("hot")) == [("hot", "19998", None)] and table.read().count() == 13_334


def test_runs_replace_rows(spark, archive, tmp_path):  # noqa: F811
    harvests, runs = str(tmp_path / "harvests"), str(tmp_path / "runs")
    main = KeyedTable.create(spark, str(tmp_path / "main"), buckets=3)
    for _ in range(2):
        row = save_run(spark, archive, sequences(), main, harvests, runs).first()
        assert (row["operation_status"], row["records_processed"]) == ("finished", 4)
    assert main.read().count() == 4 and main.manifest().version == 2
    assert main.get("1").first()["title"] == "Story"


def test_text_steps_are_written_back(spark, archive, tmp_path):  # noqa: F811
    main = KeyedTable.create(spark, str(tmp_path / "main"), buckets=3)
    save_run(spark, archive, sequences(), main, str(tmp_path / "harvests"), str(tmp_path / "runs"))
    before = {r["key"]: r.asDict() for r in main.read().collect()}
    reprocess_table(main, [steps.word_tokens(), steps.flesch_reading_ease(), steps.web_page_type({"news": ["/forum/"]})])
    after = {r["key"]: r.asDict() for r in main.read().collect()}
    assert set(after) == set(before)
    assert after["1"]["web_page_type"] == "news" and before["1"]["web_page_type"] == "forum"
    assert int(after["1"]["n_sentences"]) == 3 and float(after["1"]["reading_ease"]) > 0
    assert after["4"]["n_words"] is None  # a revisit stays as it is
    assert all(after[k][c] == before[k][c] for k in before for c in before[k] if c != "web_page_type")


def test_a_stream_saves_each_file_once(spark, archive, tmp_path, monkeypatch):  # noqa: F811
    harvests, runs, checkpoint = (str(tmp_path / name) for name in ("harvests", "runs", "checkpoint"))
    main = KeyedTable.create(spark, str(tmp_path / "main"), buckets=3)
    from warcloom.plans import run as run_module

    counts = run_module.registry.run_counts
    monkeypatch.setattr(run_module.registry, "run_counts", lambda *a: (_ for _ in ()).throw(RuntimeError("killed behind the table")))
    with pytest.raises(Exception):
        save_new_files(spark, archive, sequences(), main, harvests, runs, checkpoint)
    assert main.manifest().version == 1
    monkeypatch.setattr(run_module.registry, "run_counts", counts)
    save_new_files(spark, archive, sequences(), main, harvests, runs, checkpoint)  # the same batch again
    assert main.manifest().version == 1 and main.read().count() == 4
    log = spark.read.parquet(runs).collect()
    assert [(r["operation_status"], r["records_processed"]) for r in log] == [("finished", 4)]
    (tmp_path / "Test-2020-02-20200201000000000-00001-1~crawler.warc.gz").write_bytes(gzip.compress(record("response", 77, PAGE)))
    save_new_files(spark, archive, sequences(), main, harvests, runs, checkpoint)
    assert main.manifest().version == 2 and main.read().count() == 5 and spark.read.parquet(harvests).count() == 2


def test_buckets_follow_the_key(spark):
    frame = spark.range(1000).select(keyed._bucket(F.col("id").cast("string"), 16).alias("b"))
    assert {r[0] for r in frame.distinct().collect()} == set(range(16))
