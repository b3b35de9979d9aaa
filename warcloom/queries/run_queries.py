"""Keyed tables that runs write, steps that score or fail."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from warcloom.functions import tokens as tk
from warcloom.operators import classify, registry
from warcloom.operators.linear import collect_model, fit_svm, topics_of, usable_model
from warcloom.plans import steps
from warcloom.plans.run import process, reprocess_table
from warcloom.queries.catalog import query, table
from warcloom.queries.inputs import ORACLE_GATED, ORACLE_RECORDS, records, stoplists
from warcloom.queries.oracle_parts import text_statistics, token_list
from warcloom.queries.table_queries import _RUN, _SEEN
from warcloom.session import shared_folder
from warcloom.sources.keyed import KeyedTable


def _keyed(spark, columns):
    return KeyedTable.create(spark, shared_folder(spark, "keyed"), columns, buckets=16)


@query(
    ORACLE_RECORDS
    + """, first AS (SELECT id AS key, url, mime_type, harvest_id FROM rec WHERE page_id % 2 = 0
), second AS (SELECT id AS key, url || '#again' AS url, response_code FROM rec WHERE page_id % 3 = 0)
SELECT key, coalesce(second.url, first.url) AS url, mime_type, harvest_id, response_code FROM first FULL JOIN second USING (key)"""
)
def keyed_runs(spark, sf_dir):
    # a run, a second run with another column, and the second one again, which must change nothing
    every = records(spark, sf_dir).withColumn("key", F.col("id"))
    main = _keyed(spark, "key string, url string, mime_type string, harvest_id string")
    main.upsert(every.filter("page_id % 2 = 0").select("key", "url", "mime_type", "harvest_id"), batch_of=("runs", 1))
    again = every.filter("page_id % 3 = 0").select("key", F.concat("url", F.lit("#again")).alias("url"), "response_code")
    for _ in range(2):
        main.upsert(again, batch_of=("runs", 2))
    return main.read()


@query("SELECT url AS key, page_id FROM pages WHERE url = (SELECT max(url) FROM pages)")
def keyed_get(spark, sf_dir):
    # the key comes from the data; its bucket alone is read
    rows = table(spark, sf_dir, "pages").select(F.col("url").alias("key"), "page_id")
    stored = _keyed(spark, "key string, page_id bigint")
    stored.upsert(rows)
    return stored.get(rows.agg(F.max("key")).first()[0])


@query(
    f"""WITH {text_statistics('documents', 'doc_id', 'text', 'lang')}
SELECT CAST(doc_id AS VARCHAR) AS key, lang AS language, source AS harvest_id,
  CASE WHEN doc_id % 10 <> 0 THEN n_sentences END AS n_sentences, CASE WHEN doc_id % 10 <> 0 THEN n_words END AS n_words,
  CASE WHEN doc_id % 10 <> 0 THEN reading_ease END AS reading_ease,
  CASE WHEN doc_id % 10 <> 0 AND contains(source, '1') THEN 'news' ELSE 'others' END AS web_page_type
FROM statistics s JOIN documents d ON d.doc_id = s.key"""
)
def reprocess_write_back(spark, sf_dir):
    # stored rows have text and language; every tenth is a revisit, which stays as it is
    main = _keyed(spark, "key string")
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("key"),
        F.col("text").alias("plain_text"),
        F.col("lang").alias("language"),
        F.col("source").alias("harvest_id"),
        F.when(F.col("doc_id") % 10 == 0, "urn:uuid:0").otherwise("").alias("refers_to"),
        F.lit("others").alias("web_page_type"),
        F.to_json(F.struct(F.concat(F.lit("http://h/"), "source").alias("url"))).alias("IF"),
    )
    main.upsert(rows)
    reprocess_table(main, [steps.word_tokens(), steps.flesch_reading_ease(), steps.web_page_type({"news": ["1"]})])
    return main.read().select(
        "key",
        "language",
        "harvest_id",
        *(F.col(name).cast("bigint").alias(name) for name in ["n_sentences", "n_words"]),
        F.round(F.col("reading_ease").cast("double"), 6).alias("reading_ease"),
        "web_page_type",
    )


def _isolated(spark, sf_dir):
    """Records with a step that raises on every page whose URL's length divides by seven."""

    def longest(rows: pd.DataFrame) -> pd.DataFrame:
        if (rows["url"].str.len() % 7 == 0).any():
            raise ValueError("seven")
        return rows["content"].map(lambda body: max(map(len, bytes(body).split(b"\n")))).to_frame("longest_line")

    step = steps.python_step("longest line", longest, {"longest_line": "bigint"}, ["content", "url"])
    return process(records(spark, sf_dir), {"HTML": [step, steps.web_page_type()]})


_LONGEST = "list_max(list_transform(string_split(content, chr(10)), lambda x: octet_length(encode(x))))"


@query(
    ORACLE_GATED
    + f""" SELECT id, CASE WHEN NOT is_revisit THEN 'others' END AS web_page_type,
  CASE WHEN NOT is_revisit AND length(url) % 7 <> 0 THEN CAST({_LONGEST} AS BIGINT) END AS longest_line,
  CASE WHEN NOT is_revisit AND length(url) % 7 = 0 THEN 'step longest line: ValueError: seven' END AS failure
FROM gated WHERE drop_reason IS NULL AND mime_group = 'HTML'"""
)
def step_isolation(spark, sf_dir):
    failure = F.get(F.filter("errors", lambda message: message.startswith(steps.FAILED_STEP)), F.lit(0))
    return _isolated(spark, sf_dir).processed.select("id", "web_page_type", "longest_line", failure.alias("failure"))


@query(
    ORACLE_GATED
    + f""", failing AS (SELECT *, drop_reason IS NULL AND mime_group = 'HTML' AND NOT is_revisit AND length(url) % 7 = 0 AS failed FROM (
    SELECT * REPLACE (CASE WHEN drop_reason IS NULL AND mime_group <> 'HTML' THEN 'mime type' ELSE drop_reason END AS drop_reason) FROM gated))
SELECT count(*) FILTER (WHERE drop_reason IS NULL AND NOT failed) AS records_processed,
  count(*) FILTER (WHERE failed) AS records_failed,
  (SELECT string_agg(h, ',' ORDER BY h) FROM (SELECT DISTINCT harvest_id AS h FROM gated WHERE {_SEEN} AND harvest_id <> ''))
    AS harvests FROM failing"""
)
def step_failures(spark, sf_dir):
    results = _isolated(spark, sf_dir).results
    counts = registry.run_counts(results, F.col("scan_error").isNotNull() | steps.failed_steps(results))
    return counts.withColumn("harvests", F.array_join("harvests", ","))


def _trained_sql(name):
    """{name}_model and {name}_bias of the documents in {name}_labelled(doc_id, class), as `classify.fit_linear_model` does."""
    return f"""{name}_in AS (
  SELECT l.class, t.term, count(*) AS n_in FROM {name}_labelled l JOIN tokens t USING (doc_id) GROUP BY l.class, t.term
), {name}_all AS (SELECT term, count(*) AS n_all FROM tokens WHERE doc_id IN (SELECT doc_id FROM {name}_labelled) GROUP BY term
), {name}_totals AS (SELECT class, CAST(sum(n_in) AS DOUBLE) AS t_in FROM {name}_in GROUP BY class
), {name}_size AS (SELECT CAST(sum(n_all) AS DOUBLE) AS t_all, count(*) AS n_terms FROM {name}_all
), {name}_model AS (
  SELECT i.class, i.term, ln((n_in + 1.0::DOUBLE) / (t_in + n_terms)) - ln((n_all - n_in + 1.0::DOUBLE) / (t_all - t_in + n_terms)) AS weight
  FROM {name}_in i JOIN {name}_all USING (term) JOIN {name}_totals USING (class), {name}_size
), {name}_bias AS (
  SELECT class, ln((count(*) + 1.0::DOUBLE) / ((SELECT count(DISTINCT doc_id) FROM {name}_labelled) - count(*) + 1)) AS bias
  FROM {name}_labelled GROUP BY class
), {name}_scores AS (
  SELECT p.page_id, b.class, max(b.bias) + coalesce(sum(m.weight), 0) AS score
  FROM (SELECT DISTINCT page_id FROM page_tokens) p CROSS JOIN {name}_bias b
  LEFT JOIN (SELECT t.page_id, m.class, m.weight FROM page_tokens t JOIN {name}_model m USING (term)) m
    ON m.page_id = p.page_id AND m.class = b.class
  GROUP BY p.page_id, b.class)"""


def _topic_labels(spark, sf_dir):
    graded = table(spark, sf_dir, "labels")
    sources = graded.select("doc_id").join(table(spark, sf_dir, "documents"), "doc_id")
    return sources.select("doc_id", F.col("source").alias("class")).union(graded.filter("quality = 1").select("doc_id", F.lit("quality"))).distinct()


@query(
    _RUN
    + f""", tokens AS (SELECT doc_id, unnest({token_list('text')}) AS term FROM documents
), page_tokens AS (SELECT page_id, unnest({token_list('plain_text')}) AS term FROM run WHERE active AND language = 'en'
), topics_labelled AS (
  SELECT DISTINCT l.doc_id, d.source AS class FROM labels l JOIN documents d USING (doc_id)
  UNION SELECT doc_id, 'quality' FROM labels WHERE quality = 1
), mood_labelled AS (SELECT doc_id, CASE toxic WHEN 1 THEN 'negative' ELSE 'positive' END AS class FROM labels
), {_trained_sql('topics')}, {_trained_sql('mood')}
SELECT id, language, n_tokens, web_page_type, topics, sentiment FROM run
LEFT JOIN (SELECT page_id, coalesce(string_agg(class, ',' ORDER BY class) FILTER (WHERE score > 0), '') AS topics
  FROM topics_scores GROUP BY page_id) USING (page_id)
LEFT JOIN (SELECT page_id, round(tanh((max(score) FILTER (WHERE class = 'positive') - max(score) FILTER (WHERE class = 'negative')) / 2), 6)
  AS sentiment FROM mood_scores GROUP BY page_id) USING (page_id)"""
)
def algseq_topics(spark, sf_dir):
    # the usual sequence with trained models: text, tokens, topics, sentiment, page type
    texts = table(spark, sf_dir, "documents")
    moods = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "negative").otherwise("positive").alias("class"))
    topics, mood = (usable_model(*classify.fit_linear_model(texts, "doc_id", tk.tokens(F.col("text")), own)) for own in (_topic_labels(spark, sf_dir), moods))
    html = [steps.html_text(stoplists(spark, sf_dir)), steps.word_tokens(), steps.topics(topics, "en"), steps.sentiment(mood, "en"), steps.web_page_type()]
    return process(records(spark, sf_dir), {"HTML": html, "PDF": []}).processed.select(
        "id",
        "language",
        F.when(F.col("plain_text_tokens").isNotNull(), F.size("plain_text_tokens").cast("bigint")).alias("n_tokens"),
        "web_page_type",
        F.array_join("topics", ",").alias("topics"),
        F.round("sentiment", 6).alias("sentiment"),
    )


@query()
def topic_svm(spark, sf_dir):
    # trained machines have no form in SQL; tests compare them with a plain version
    texts, tokens = table(spark, sf_dir, "documents"), tk.tokens(F.col("text"))
    graded = table(spark, sf_dir, "labels")
    labels = graded.select(
        "doc_id", F.explode(F.array(F.when(F.col("quality") == 1, "quality").otherwise("poor"), F.when(F.col("toxic") == 1, "toxic"))).alias("class")
    )
    model = collect_model(*fit_svm(texts, "doc_id", tokens, labels, iterations=20))
    return texts.select("doc_id", F.array_join(topics_of(spark, model)(tokens), ",").alias("topics"))
