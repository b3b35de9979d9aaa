"""Inputs that several queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.fixed_values import STOPLIST_SIZE
from warcloom.operators.language import Stoplists, collect_stoplists, corpus_words, top_words, word_counts
from warcloom.operators.records import normalise, normalisation_errors
from warcloom.queries.catalog import table

# Raw record fields derived from pages, valid in Spark and in DuckDB. `{pages}` is the table.
RECORDS_SQL = """
SELECT page_id,
  CASE WHEN page_id % 10 = 0 THEN 'revisit' WHEN page_id % 10 = 9 THEN 'request' ELSE 'response' END AS warc_type,
  CASE WHEN page_id % 13 = 0 THEN NULL
       ELSE '<urn:uuid:00000000-0000-4000-8000-' || lpad(CAST(page_id AS string), 12, '0') || '>' END AS raw_id,
  url,
  CASE WHEN page_id % 10 = 0
       THEN '<urn:uuid:00000000-0000-4000-8000-' || lpad(CAST(page_id + 1 AS string), 12, '0') || '>' END AS raw_refers_to,
  CASE page_id % 8 WHEN 1 THEN '404' WHEN 2 THEN '301' WHEN 3 THEN '201' ELSE '200' END AS response_code,
  CASE page_id % 6 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'application/xhtml+xml;charset="ISO-8859-2"'
       WHEN 2 THEN 'application/pdf' WHEN 3 THEN 'Text/HTML' WHEN 4 THEN NULL ELSE 'text/html' END AS content_type,
  CASE WHEN page_id % 8 IN (1, 2, 3) THEN '/moved/' || CAST(page_id AS string) END AS location,
  CASE page_id % 4
       WHEN 0 THEN 'file:/data/CZ-2015-12-20151224071107633-01001-11606~crawler18.example.cz~7778.warc.gz'
       WHEN 1 THEN '/data/MigrantCrisisEU-2015-02-20160220233522082-00275-8523~crawler00.example.cz~7778.warc.gz'
       WHEN 2 THEN 'Test-2019-06-30-cc-naki-crawler00-20190701115137757-00008-12296~crawler00.example.cz~7778.warc.gz'
       ELSE 'no-harvest.warc.gz' END AS raw_filename,
  CASE WHEN page_id % 17 = 0 THEN 'n/a' WHEN page_id % 29 = 0 THEN '100000001' ELSE CAST(length(html) AS string) END AS raw_size,
  page_id * 1000 AS warc_offset,
  '2015-12-24T07:11:' || lpad(CAST(page_id % 60 AS string), 2, '0') || 'Z' AS warc_date,
  html AS content
FROM {pages}
"""

CRLF = "\r\n"


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RECORDS_SQL, pages=table(spark, sf_dir, "pages"))


def _line(name: str, column: str):
    return F.concat(F.lit(f"{name}: "), F.col(column))


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records in the form the WARC scan gives, with `page_id`."""
    return raw_records(spark, sf_dir).select(
        "page_id",
        F.col("raw_filename").alias("warc_filename"),
        "warc_offset",
        F.concat_ws(
            CRLF,
            F.lit("WARC/1.0"),
            _line("WARC-Type", "warc_type"),
            _line("WARC-Record-ID", "raw_id"),
            _line("WARC-Target-URI", "url"),
            _line("WARC-Refers-To", "raw_refers_to"),
            _line("WARC-Date", "warc_date"),
            _line("Content-Length", "raw_size"),
        ).alias("rec_block"),
        F.concat_ws(
            CRLF,
            F.concat(F.lit("HTTP/1.1 "), F.col("response_code"), F.lit(" Status")),
            _line("Content-Type", "content_type"),
            _line("Location", "location"),
        ).alias("http_block"),
        F.encode("content", "UTF-8").alias("content"),
        F.lit(None).cast("string").alias("scan_error"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised records of all pages, with `page_id` and `errors`."""
    return normalise(scanned(spark, sf_dir)).withColumn("errors", normalisation_errors())


# The same records in SQL, for the oracles: WITH raw AS (...), rec AS (...).
ORACLE_RECORDS = (
    "WITH raw AS ("
    + RECORDS_SQL.format(pages="pages")
    + r"""), named AS (
  SELECT *, regexp_replace(raw_filename, '^file:', '') AS warc_filename,
    regexp_extract(raw_filename, '[^/]*$', 0) AS base_name,
    trim(split_part(coalesce(content_type, ''), ';', 1)) AS mime_type,
    CASE WHEN regexp_full_match(raw_size, '[0-9]+') THEN CAST(raw_size AS BIGINT) END AS warc_record_size,
    md5(regexp_replace(raw_filename, '^file:', '') || '|' || CAST(warc_offset AS VARCHAR)) AS digest,
    trim(raw_refers_to, '<>') AS refers_to,
    CASE WHEN regexp_full_match(response_code, '3[0-9][0-9]|201|202') THEN location END AS redirect_url
  FROM raw
), rec AS (
  SELECT *,
    CASE WHEN raw_id IS NULL THEN 'urn:uuid:' || substr(digest, 1, 8) || '-' || substr(digest, 9, 4) || '-'
      || substr(digest, 13, 4) || '-' || substr(digest, 17, 4) || '-' || substr(digest, 21, 12)
      ELSE trim(raw_id, '<>') END AS id,
    regexp_extract(base_name, '^(.+)-([0-9]{8,})-', 1) AS harvest_id,
    split_part(regexp_extract(base_name, '^(.+)-([0-9]{8,})-', 1), '-', 1) AS harvest_type,
    left(regexp_extract(base_name, '^(.+)-([0-9]{8,})-', 2), 8) AS harvest_date,
    refers_to IS NOT NULL AS is_revisit,
    CASE WHEN regexp_matches(mime_type, '(?i)^(text/html|application/xhtml\+xml)') THEN 'HTML'
         WHEN regexp_matches(mime_type, '(?i)^application/pdf') THEN 'PDF'
         WHEN regexp_matches(mime_type, '(?i)^image') THEN 'IMG' END AS mime_group
  FROM named
)"""
)

# Adds the gates: gated(..., drop_reason).
ORACLE_GATED = (
    ORACLE_RECORDS
    + r""", gated AS (
  SELECT *, CASE
    WHEN warc_type NOT IN ('response', 'revisit') THEN 'record type'
    WHEN warc_record_size IS NULL OR warc_record_size > 100000000 THEN 'record size'
    WHEN NOT regexp_full_match(response_code, '2[0-9][0-9]') THEN 'metadata filter'
    WHEN NOT regexp_full_match(mime_type, '[a-z]+/[a-zA-Z0-9.+-]+') THEN 'invalid record'
    WHEN mime_group IS NULL THEN 'mime type' END AS drop_reason
  FROM rec
)"""
)

STOPLIST_WORDS = STOPLIST_SIZE


def stoplist_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return word_counts(corpus_words(documents, F.col("text"), F.col("lang")))


def stoplists(spark: SparkSession, sf_dir: str) -> Stoplists:
    """The 1,000 most frequent words per language of all documents: a bounded result, used as a parameter."""
    return collect_stoplists(top_words(stoplist_counts(spark, sf_dir), STOPLIST_WORDS))
