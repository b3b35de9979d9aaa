"""Steps, tables and whole runs."""

import gzip

import pytest
from pyspark.sql import functions as F
from test_warc import record

from warcloom.operators import classify, output, registry
from warcloom.operators.gates import gate_report, only_ids
from warcloom.operators.language import collect_stoplists, coverage, top_words, write_stoplists
from warcloom.operators.ranking import top_n_per_group
from warcloom.plans import steps
from warcloom.plans.run import process_warcs, reprocess, save_run
from warcloom.sources.listing import stoplist_words

STOPWORDS = {"en": ["the", "of", "and", "is", "to", "in"]}
GOOD = "The end of the story is in the house and the garden of the king is to the north. " * 3
PAGE = f"<html><head><title>Story</title></head><body><h1>Head</h1><p>{GOOD}</p><a href='/x'>x</a></body></html>".encode()


@pytest.fixture()
def archive(tmp_path):
    name = tmp_path / "Test-2020-01-20200101000000000-00001-1~crawler.warc.gz"
    members = [
        record("request", 0, b"GET /", http=False),
        record("response", 1, PAGE, url="http://example.com/forum/1"),
        record("response", 2, b"%PDF", fields=["Content-Type: application/pdf"]),
        record("response", 3, b"GIF", fields=["Content-Type: image/gif"]),
        record("revisit", 4, b"", warc_fields=["WARC-Refers-To: <urn:uuid:1>"]),
        record("response", 5, PAGE, fields=["Content-Type: NO/HTML"]),
        record("response", 6, b" \n "),
    ]
    name.write_bytes(b"".join(gzip.compress(m) for m in members))
    return f"file://{tmp_path}/*.warc.gz"


def sequences():
    return {
        "HTML": [
            steps.html_text(STOPWORDS),
            steps.word_tokens(),
            steps.sentence_tokens(),
            steps.web_page_type(),
            steps.flesch_reading_ease(),
        ],
        "PDF": [],
    }


def test_run_over_files(spark, archive):
    run = process_warcs(spark, archive, sequences())
    assert {r["reason"]: r["n_records"] for r in gate_report(run.results).collect()} == {
        "kept": 4,
        "mime type": 1,
        "invalid record": 1,
        "record type": 1,
    }
    rows = {r["id"]: r for r in run.processed.collect()}
    assert sorted(rows) == ["urn:uuid:1", "urn:uuid:2", "urn:uuid:4", "urn:uuid:6"]
    page = rows["urn:uuid:1"]
    assert (page["title"], page["headlines"], page["language"]) == ("Story", ["Head"], "en")
    assert page["links"] == ["http://example.com/x"] and page["web_page_type"] == "forum"
    assert page["plain_text"].split() == GOOD.split() and page["n_sentences"] == 3
    assert page["plain_text_tokens"][:2] == ["The", "end"] and len(page["plain_text_sentences"]) == 3
    assert rows["urn:uuid:2"]["web_page_type"] is None and rows["urn:uuid:2"]["n_words"] is None
    assert rows["urn:uuid:4"]["is_revisit"] and rows["urn:uuid:4"]["web_page_type"] is None
    blank = rows["urn:uuid:6"]
    assert blank["title"] is None and blank["plain_text"] is None and blank["web_page_type"] == "others"
    assert (blank["n_words"], blank["reading_ease"]) == (0, None)


def test_run_with_id_list(spark, archive):
    ids = spark.createDataFrame([("urn:uuid:1",), ("urn:uuid:9",)], "id string")
    run = process_warcs(spark, archive, sequences(), ids)
    assert [r["id"] for r in run.processed.select("id").collect()] == ["urn:uuid:1"]
    assert {r["reason"]: r["n_records"] for r in gate_report(run.results).collect()} == {
        "kept": 1,
        "not listed": 5,
        "record type": 1,
    }
    empty = spark.createDataFrame([], "id string")
    rows = spark.createDataFrame([("a",)], "id string")
    assert only_ids(rows, empty).count() == 1 and only_ids(rows, ids).count() == 0


def test_saved_run(spark, archive, tmp_path):
    main, harvests, runs = (str(tmp_path / name) for name in ("main", "harvests", "runs"))
    row = save_run(spark, archive, sequences(), main, harvests, runs, args="--test").first()
    assert (row["operation_status"], row["records_processed"], row["records_failed"]) == ("finished", 4, 0)
    assert row["harvests"] == ["Test-2020-01"]
    assert [tuple(r) for r in spark.read.parquet(harvests).collect()] == [("Test-2020-01", "Test", "20200101")]
    stored = spark.read.parquet(main)
    found = registry.get_row(stored, "1").first()
    assert found["title"] == "Story" and found["web_page_type"] == "forum" and '"warc-offset":' in found["IF"]
    assert "content" not in stored.columns and '"content"' not in found["IF"]
    assert registry.has_row(stored, "1") and not registry.has_row(stored, "none")
    assert registry.prefix_scan(stored, "").count() == 4
    # a second run knows the harvest already
    save_run(spark, archive, sequences(), main, harvests, runs)
    assert spark.read.parquet(harvests).count() == 1 and spark.read.parquet(runs).count() == 2


def test_reprocess_stored_rows(spark):
    stored = spark.createDataFrame(
        [("1", "Dobrý den. Toto je test.", "cs", ""), ("2", "x", "cs", "urn:uuid:1")],
        "key string, plain_text string, language string, refers_to string",
    )
    rows = {r["key"]: r for r in reprocess(stored, [steps.flesch_reading_ease()]).collect()}
    assert (rows["1"]["n_sentences"], rows["1"]["n_words"], rows["1"]["n_syllables"]) == (2, 5, 7)
    assert rows["2"]["n_words"] is None and rows["2"]["plain_text"] == "x"


def test_sequence_text():
    known = {s.name: s for s in [steps.word_tokens(), steps.pdf_text()]}
    assert steps.parse_sequence("PDF:", known) == ("PDF", [])
    group, chosen = steps.parse_sequence("HTML:WordTokenizer,PDFTextExtractor", known)
    assert group == "HTML" and [s.name for s in chosen] == ["WordTokenizer", "PDFTextExtractor"]
    for wrong in ["HTML", "VIDEO:WordTokenizer", "HTML:Nothing"]:
        with pytest.raises(ValueError):
            steps.parse_sequence(wrong, known)


def test_steps_per_group(spark):
    def mark(name):
        return steps.Step(
            name,
            lambda rows: rows.withColumn("trace", F.concat(F.coalesce("trace", F.lit("")), F.lit(name))),
            {"trace": "string"},
            ["trace"],
        )

    a, b = mark("a"), mark("b")
    rows = spark.createDataFrame(
        [("H", False), ("P", False), ("H", True), ("X", False)], "mime_group string, is_revisit boolean"
    ).withColumn("trace", F.lit(None).cast("string"))
    done = steps.run_steps(rows, {"H": [a, b], "P": [b, a]})
    assert sorted((r["mime_group"], r["is_revisit"], r["trace"]) for r in done.collect() if r["trace"]) == [
        ("H", False, "ab"),
        ("P", False, "ba"),
    ]
    assert done.count() == 3


def test_upsert_keeps_unnamed_cells(spark):
    stored = spark.createDataFrame([("k", "a", "b"), ("old", "x", "y")], "key string, c1 string, c2 string")
    batch = spark.createDataFrame([("k", "new", 1), ("k", None, 2), ("new", "z", 1)], "key string, c1 string, v int")
    rows = sorted(map(tuple, output.upsert(stored, batch, version="v").collect()))
    assert rows == [("k", "new", "b"), ("new", "z", None), ("old", "x", "y")]


def test_cells(spark):
    rows = spark.sql("SELECT 'k' AS key, 'text' AS a, 1 AS b, array('x') AS c, CAST(NULL AS string) AS d, map('m', 1) AS e")
    assert sorted((r["column"], r["value"]) for r in output.cells(rows).collect()) == [
        ("a", "text"), ("b", "1"), ("c", '["x"]'), ("e", '{"m":1}'),
    ]


def test_top_rows_of_a_hot_group(spark):
    rows = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'g' || id % 50 END AS g", "id", "id * 7919 % 1009 AS n")
    order = [F.col("n").desc(), F.col("id").asc()]
    found = {(r["g"], r["rank"]): r["id"] for r in top_n_per_group(rows, ["g"], order, 4, ["id"]).collect()}
    groups = {}
    for g, i, n in rows.collect():
        groups.setdefault(g, []).append((-n, i))
    want = {(g, k + 1): i for g, members in groups.items() for k, (_, i) in enumerate(sorted(members)[:4])}
    assert found == want


def test_stoplists_are_written_and_read(spark, tmp_path):
    counts = spark.createDataFrame(
        [("cs", "a", 5), ("cs", "je", 9), ("cs", "zde", 1), ("en", "the", 3)], "lang string, word string, n long"
    )
    ranked = top_words(counts, 2)
    write_stoplists(ranked, str(tmp_path / "lists"))
    lines = spark.read.text(str(tmp_path / "lists"))
    assert collect_stoplists(stoplist_words(lines)) == {"cs": ["a", "je"], "en": ["the"]}
    assert [r["value"] for r in lines.filter("lang = 'cs'").collect()] == ["je\t9", "a\t5"]
    shares = {r["lang"]: float(r["coverage"]) for r in coverage(counts, 2).collect()}
    assert shares["en"] == 100 and abs(shares["cs"] - 1400 / 15) < 1e-9


def test_topics_with_positive_bias(spark):
    model = spark.createDataFrame([("sport", "goal", 2.0), ("war", "goal", -3.0)], "class string, term string, weight double")
    bias = spark.createDataFrame([("sport", -1.0), ("war", 0.5), ("news", 0.1)], "class string, bias double")
    texts = spark.createDataFrame(
        [(1, ["goal", "goal"], "cs"), (2, ["other"], "cs"), (3, ["goal"], "en"), (4, [], "cs")],
        "k int, tokens array<string>, lang string",
    )
    scores = classify.class_scores(texts, "k", "tokens", model, bias, "lang")
    found = {r["k"]: r["topics"] for r in classify.topics(scores, "k", bias).collect()}
    assert found == {1: ["news", "sport"], 2: ["news", "war"]}
    # a model too large for a broadcast gives the same
    joined = classify.class_scores(texts, "k", "tokens", model, bias, "lang")
    assert sorted(map(str, joined.collect())) == sorted(map(str, scores.collect()))


def test_sentiment_is_a_softmax_difference(spark):
    import math

    model = spark.createDataFrame(
        [("positive", "dobrý", 1.5), ("negative", "hnus", 900.0)], "class string, term string, weight double"
    )
    bias = spark.createDataFrame([("positive", 0.2), ("negative", -0.1)], "class string, bias double")
    texts = spark.createDataFrame([(1, ["dobrý"], "cs"), (2, ["hnus"], "cs")], "k int, tokens array<string>, lang string")
    scores = classify.class_scores(texts, "k", "tokens", model, bias, "lang")
    found = {r["k"]: r["sentiment"] for r in classify.sentiment(scores, "k", bias).collect()}
    p, n = math.exp(1.7), math.exp(-0.1)
    assert abs(found[1] - (p - n) / (p + n)) < 1e-12 and found[2] == -1.0


def test_vocabulary_documents(spark):
    import json

    vocabularies = classify.fixed_vocabulary(spark, "webtypes", {"eshop": 0, "news": 1})
    document = json.loads(classify.vocabulary_json(vocabularies).first()["document"])
    assert document == {"webtypes": {"value": {"eshop": 0, "news": 1}}}


def test_point_reads_reach_the_scan(spark, tmp_path):
    rows = spark.range(1000).selectExpr("format_string('%04d', id) AS key", "id AS v")
    output.write_table(rows, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = registry.get_row(stored, "0042")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(key,0042)" in plan and registry.get_row(stored, "0042").first()["v"] == 42
    scan = registry.prefix_scan(stored, "004")
    assert "StringStartsWith(key,004)" in scan._jdf.queryExecution().executedPlan().toString() and scan.count() == 10


def test_new_files_only(spark, archive, tmp_path):
    from warcloom.streaming.incremental import save_new_files

    main, harvests, runs, checkpoint = (str(tmp_path / name) for name in ("main", "harvests", "runs", "checkpoint"))
    for _ in range(2):
        save_new_files(spark, archive, sequences(), main, harvests, runs, checkpoint)
    assert spark.read.parquet(main).count() == 4
    later = tmp_path / "Test-2020-02-20200201000000000-00001-1~crawler.warc.gz"
    later.write_bytes(gzip.compress(record("response", 77, PAGE)))
    save_new_files(spark, archive, sequences(), main, harvests, runs, checkpoint)
    assert spark.read.parquet(main).count() == 5 and spark.read.parquet(harvests).count() == 2


def test_failed_run_is_logged(spark, archive, tmp_path):
    main, harvests, runs = (str(tmp_path / name) for name in ("main", "harvests", "runs"))
    (tmp_path / "main").write_text("in the way")
    with pytest.raises(Exception):
        save_run(spark, archive, sequences(), main, harvests, runs)
    assert [r["operation_status"] for r in spark.read.parquet(runs).collect()] == ["failed"]


def test_undecoded_payload_is_not_extracted(spark, tmp_path):
    try:
        import brotli  # noqa: F401
    except ImportError:
        pass
    else:
        pytest.skip("brotli can be decoded here")
    body = record("response", 1, PAGE, fields=["Content-Encoding: br"])
    (tmp_path / "Test-2020-01-20200101000000000-1.warc").write_bytes(body)
    row = process_warcs(spark, f"{tmp_path}/*.warc", sequences()).processed.first()
    assert row["title"] is None and row["plain_text"] is None and "not decoded" in row["scan_error"]
    assert bytes(row["content"]) == PAGE
