"""Sources, steps, stored rows, registries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from warcloom.operators import gates, output, registry
from warcloom.operators.records import normalise
from warcloom.plans import steps
from warcloom.plans.run import process, reprocess
from warcloom.queries.catalog import query, table
from warcloom.queries.inputs import CRLF, ORACLE_GATED, ORACLE_RECORDS, STOPLIST_WORDS, records, stoplists
from warcloom.queries.oracle_parts import PLAIN_TEXT, CLEANED, decoded, page_blocks, squeezed, text_statistics, token_list
from warcloom.session import shared_folder
from warcloom.sources import warc_format
from warcloom.sources.listed import scan_listed
from warcloom.sources.listing import config_cells, files
from warcloom.sources.warc import scan

_HTTP = "'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || chr(13) || chr(10)"


def write_warcs(spark, sf_dir):
    """All pages as WARC files in the shared folder; returns their glob. One record ends with two line ends."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html{CRLF}{CRLF}"), F.col("html"))
    record = F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: response{CRLF}WARC-Record-ID: <urn:uuid:"),
        F.lpad(F.col("page_id").cast("string"), 12, "0"),
        F.lit(f">{CRLF}WARC-Target-URI: "),
        F.col("url"),
        F.lit(f"{CRLF}WARC-Date: 2015-12-24T07:11:07Z{CRLF}Content-Length: "),
        F.octet_length(http).cast("string"),
        F.lit(f"{CRLF}{CRLF}"),
        http,
        F.lit(CRLF),
    )
    path = shared_folder(spark, "warc")
    table(spark, sf_dir, "pages").select(record.alias("value")).write.option("lineSep", CRLF).text(path)
    return f"{path}/part-*"


@query(
    """SELECT 'urn:uuid:' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS id, url, '200' AS response_code,
  'text/html' AS mime_type, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes, md5(html) AS payload FROM pages"""
)
def warc_scan(spark, sf_dir):
    found = normalise(scan(spark, write_warcs(spark, sf_dir)))
    return found.select(
        "id",
        "url",
        "response_code",
        "mime_type",
        F.octet_length("content").cast("bigint").alias("n_bytes"),
        F.md5("content").alias("payload"),
    )


@query(
    """SELECT 'urn:uuid:' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS id, url,
  CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes, md5(html) AS payload FROM pages"""
)
def warc_scan_ranges(spark, sf_dir):
    # the plain files are read in ranges of a megabyte
    found = normalise(scan(spark, write_warcs(spark, sf_dir), split_bytes=1 << 20))
    size = F.octet_length("content").cast("bigint")
    return found.select("id", "url", size.alias("n_bytes"), F.md5("content").alias("payload"))


# Size of a record as its header states it.
_SIZE = f"octet_length(encode({_HTTP} || html))"


@query(
    f"""SELECT 'urn:uuid:' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS id, CAST({_SIZE} AS BIGINT) AS n_bytes,
  md5(html) AS payload FROM pages WHERE {_SIZE} <= 2000"""
)
def warc_source(spark, sf_dir):
    # type and size are filters of the source: larger pages are passed over while framing
    found = warc_format.register(spark).read.format("warc").load(write_warcs(spark, sf_dir))
    small = found.filter((F.col("warc_type") == "response") & (F.col("warc_record_size") <= 2000))
    return small.select(F.col("warc_record_id").alias("id"), F.col("warc_record_size").alias("n_bytes"), F.md5("content").alias("payload"))


@query(
    """SELECT 'urn:uuid:' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS id, html LIKE '%lang="en"%' AS is_listed,
  CASE WHEN html LIKE '%lang="en"%' THEN md5(html) END AS payload FROM pages"""
)
def listed_records(spark, sf_dir):
    # the list names the English pages; other records keep their header and no payload
    listed = table(spark, sf_dir, "pages").filter(F.col("html").contains('lang="en"'))
    name = F.concat(F.lit("urn:uuid:"), F.lpad(F.col("page_id").cast("string"), 12, "0"))
    found = scan_listed(spark, write_warcs(spark, sf_dir), listed.select(name.alias("id")))
    return normalise(found).select("id", "is_listed", F.md5("content").alias("payload"))


# Bytes of a record besides its URL, the digits of its length and its HTTP part: texts, a 12-digit ID, nine line ends.
_RECORD_BYTES = 12 + 9 * len(CRLF) + len(
    "WARC/1.0WARC-Type: responseWARC-Record-ID: <urn:uuid:>WARC-Target-URI: WARC-Date: 2015-12-24T07:11:07ZContent-Length: "
)


@query(
    f"""WITH sizes AS (SELECT url, octet_length(encode({_HTTP} || html)) AS size FROM pages)
SELECT CAST(sum(size + length(CAST(size AS VARCHAR)) + octet_length(encode(url)) + {_RECORD_BYTES}) AS BIGINT) AS n_bytes
FROM sizes"""
)
def warc_files(spark, sf_dir):
    return files(spark, write_warcs(spark, sf_dir)).agg(F.sum("length").alias("n_bytes"))


@query("SELECT source AS row, lang AS col, CAST(count(*) AS VARCHAR) AS value FROM documents GROUP BY source, lang")
def config_rows(spark, sf_dir):
    per_lang = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"))
    cells = F.map_from_entries(F.collect_list(F.struct("lang", "n")))
    documents = per_lang.groupBy("source").agg(cells.alias("cells")).select(
        F.to_json(F.create_map("source", "cells")).alias("document")
    )
    return config_cells(documents)


@query(
    f"""WITH {text_statistics('documents', 'doc_id', 'text', 'lang')}
SELECT d.doc_id AS key, d.lang AS language, s.n_sentences, s.n_words, s.n_syllables, s.reading_ease
FROM statistics s JOIN documents d ON d.doc_id = s.key"""
)
def reprocess_saved(spark, sf_dir):
    # stored rows have text and language, but no payload
    stored = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"),
        F.col("text").alias("plain_text"),
        F.col("lang").alias("language"),
        F.lit("").alias("refers_to"),
    )
    again = reprocess(stored, [steps.word_tokens(), steps.sentence_tokens(), steps.flesch_reading_ease()])
    return again.select(
        "key",
        "language",
        *(F.col(name).cast("bigint").alias(name) for name in ["n_sentences", "n_words", "n_syllables"]),
        F.round("reading_ease", 6).alias("reading_ease"),
    )


def _processed(spark, sf_dir):
    """Gated records with the usual steps: text and statistics for HTML, nothing for PDF; images are not wanted."""
    lists = stoplists(spark, sf_dir)
    html = [
        steps.html_text(lists),
        steps.word_tokens(),
        steps.web_page_type(),
        steps.flesch_reading_ease(),
    ]
    return process(records(spark, sf_dir), {"HTML": html, "PDF": [steps.pdf_text()]})


_TITLED = f"""titled AS (
  SELECT page_id, {squeezed(decoded("regexp_extract(cleaned, '(?is)<title[^>]*>(.*?)</title', 1)"))} AS title FROM cleaned)"""
# Pages as the run sees them: HTML records that are no revisits have texts.
_PROCESSED = f"""{page_blocks(STOPLIST_WORDS)}, {PLAIN_TEXT}, {text_statistics('plain', 'page_id', 'plain_text', 'language')},
{_TITLED}, run AS (
  SELECT g.*, active, CASE WHEN active THEN t.title END AS title,
    CASE WHEN active THEN p.language END AS language, CASE WHEN active THEN p.plain_text END AS plain_text,
    CASE WHEN active THEN CAST(len({token_list('p.plain_text')}) AS BIGINT) END AS n_tokens,
    CASE WHEN active THEN 'others' END AS web_page_type,
    CASE WHEN active THEN s.n_sentences END AS n_sentences, CASE WHEN active THEN s.n_words END AS n_words,
    CASE WHEN active THEN s.n_syllables END AS n_syllables, CASE WHEN active THEN s.reading_ease END AS reading_ease
  FROM (SELECT *, mime_group = 'HTML' AND NOT is_revisit AS active FROM gated
        WHERE drop_reason IS NULL AND mime_group IN ('HTML', 'PDF')) g
  JOIN titled t USING (page_id) JOIN plain p USING (page_id) JOIN statistics s ON s.key = g.page_id)"""
_RUN = ORACLE_GATED + ", " + _PROCESSED


@query(
    _RUN
    + """ SELECT id, mime_group, is_revisit, title, language, plain_text, n_tokens, web_page_type, n_words, reading_ease
FROM run"""
)
def algseq_run(spark, sf_dir):
    return _processed(spark, sf_dir).processed.select(
        "id",
        "mime_group",
        "is_revisit",
        "title",
        "language",
        "plain_text",
        F.when(F.col("plain_text_tokens").isNotNull(), F.size("plain_text_tokens").cast("bigint")).alias("n_tokens"),
        "web_page_type",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.round("reading_ease", 6).alias("reading_ease"),
    )


@query(
    ORACLE_GATED
    + """ SELECT id, mime_group, is_revisit, CASE WHEN mime_group = 'HTML' AND NOT is_revisit THEN 'others' END AS web_page_type
FROM gated WHERE drop_reason IS NULL AND mime_group IN ('HTML', 'PDF')"""
)
def revisit_bypass(spark, sf_dir):
    run = process(records(spark, sf_dir), {"HTML": [steps.web_page_type()], "PDF": []})
    return run.processed.select("id", "mime_group", "is_revisit", "web_page_type")


@query(
    ORACLE_GATED
    + """ SELECT id, CASE WHEN NOT is_revisit AND length(url) % 2 = 0 THEN 'en' END AS language,
    CASE WHEN NOT is_revisit AND length(url) % 2 = 0 THEN CAST(length(url) AS BIGINT) END AS url_length
FROM gated WHERE drop_reason IS NULL AND mime_group = 'HTML'"""
)
def rollback_guard(spark, sf_dir):
    # the step names an invalid language for URLs of odd length, so both its outputs must go there
    def guess(rows):
        even = F.length("url") % 2 == 0
        return rows.withColumns(
            {
                "language": F.when(even, "en").otherwise("English"),
                "url_length": F.length("url").cast("bigint"),
            }
        )

    step = steps.Step("guess", guess, {"language": "string", "url_length": "bigint"}, ["url"])
    return process(records(spark, sf_dir), {"HTML": [step]}).processed.select("id", "language", "url_length")


@query(
    ORACLE_GATED
    + """ SELECT id,
  CASE WHEN NOT is_revisit THEN CAST(length(content) - length(replace(content, '<p>', '  ')) AS BIGINT) END AS n_paragraphs
FROM gated WHERE drop_reason IS NULL AND mime_group = 'HTML'"""
)
def custom_step(spark, sf_dir):
    # a step of the user's own, with Arrow batches
    @F.pandas_udf("bigint")
    def paragraphs(content: pd.Series) -> pd.Series:
        return content.map(lambda body: None if body is None else body.count(b"<p>")).astype("Int64")

    step = steps.Step(
        "count paragraphs",
        lambda rows: rows.withColumn("n_paragraphs", paragraphs("content")),
        {"n_paragraphs": "bigint"},
        ["content"],
    )
    return process(records(spark, sf_dir), {"HTML": [step]}).processed.select("id", "n_paragraphs")


@query(ORACLE_RECORDS + " SELECT id, replace(id, 'urn:uuid:', '') AS key FROM rec")
def row_key(spark, sf_dir):
    return records(spark, sf_dir).select("id", output.row_key(F.col("id")).alias("key"))


_IF = """'{' || concat_ws(',', '"warc-filename":' || to_json(warc_filename), '"warc-offset":' || warc_offset,
    '"rec-headers":{' || concat_ws(',', '"WARC-Type":' || to_json(warc_type), '"WARC-Record-ID":' || to_json(raw_id),
      '"WARC-Target-URI":' || to_json(url), '"WARC-Refers-To":' || to_json(raw_refers_to), '"WARC-Date":' || to_json(warc_date),
      '"Content-Length":' || to_json(raw_size)) || '}',
    '"http-headers":{' || concat_ws(',', '"Content-Type":' || to_json(content_type), '"Location":' || to_json(location)) || '}',
    '"response-code":' || to_json(response_code), '"id":' || to_json(id), '"url":' || to_json(url),
    '"warc-record-size":' || warc_record_size, '"timestamp":' || to_json(warc_date),
    '"mime-type":' || to_json(mime_type), '"redirect-url":' || to_json(redirect_url)) || '}'"""


@query(
    ORACLE_RECORDS
    + f""", {CLEANED}, {_TITLED}
SELECT replace(id, 'urn:uuid:', '') AS key, coalesce(refers_to, '') AS refers_to, harvest_id, title,
  '' AS language, '' AS sentiment, '' AS topics, 'others' AS web_page_type, {_IF} AS "IF"
FROM rec JOIN titled USING (page_id)"""
)
def decompose(spark, sf_dir):
    from warcloom.functions.markup import clean
    from warcloom.operators.page_text import title_of

    titled = records(spark, sf_dir).withColumns(
        {
            "title": title_of(clean(F.col("content").cast("string"))),
            "web_page_type": F.lit("others"),
            "plain_text_tokens": F.array("url"),
        }
    )
    rows = output.decompose(titled.drop("page_id"))
    return rows.drop("urlkey", "plain_text", "headlines", "links")


@query(
    _RUN
    + """ SELECT replace(id, 'urn:uuid:', '') AS key, url, n_sentences, n_words, n_syllables, reading_ease FROM run"""
)
def extra_rows(spark, sf_dir):
    rows = output.extra_rows(_processed(spark, sf_dir).processed)
    return rows.select(
        "key",
        "url",
        *(F.col(name).cast("bigint").alias(name) for name in ["n_sentences", "n_words", "n_syllables"]),
        F.round("reading_ease", 6).alias("reading_ease"),
    )


@query(
    ORACLE_RECORDS
    + """ SELECT replace(id, 'urn:uuid:', '') AS key, url, mime_type, length(content) AS n_chars FROM rec"""
)
def sink_text(spark, sf_dir):
    path = shared_folder(spark, "text")
    rows = records(spark, sf_dir).select(
        output.row_key(F.col("id")).alias("key"), "url", "mime_type", F.length(F.decode("content", "UTF-8")).alias("n_chars")
    )
    output.write_text(rows, path)
    return spark.read.schema("key string, url string, mime_type string, n_chars long").json(path)


@query(
    ORACLE_RECORDS
    + """, old AS (SELECT id AS key, url, mime_type, response_code FROM rec WHERE page_id % 2 = 0
), new AS (SELECT id AS key, url || '#new' AS url, CAST(NULL AS VARCHAR) AS mime_type, response_code || '!' AS response_code
  FROM rec WHERE page_id % 3 = 0)
SELECT key, coalesce(new.url, old.url) AS url, coalesce(new.mime_type, old.mime_type) AS mime_type,
  coalesce(new.response_code, old.response_code) AS response_code FROM old FULL JOIN new USING (key)"""
)
def upsert_latest(spark, sf_dir):
    every = records(spark, sf_dir).select("page_id", F.col("id").alias("key"), "url", "mime_type", "response_code")
    stored = every.filter("page_id % 2 = 0").drop("page_id")
    # every key is put twice; the older put must lose
    puts = every.filter("page_id % 3 = 0").withColumn("turn", F.explode(F.array(F.lit(1), F.lit(2))))
    batch = puts.select(
        "key",
        F.concat("url", F.when(F.col("turn") == 2, "#new").otherwise("#old")).alias("url"),
        F.lit(None).cast("string").alias("mime_type"),
        F.concat("response_code", F.when(F.col("turn") == 2, "!").otherwise("?")).alias("response_code"),
        "turn",
    )
    return output.upsert(stored, batch, version="turn")


@query(
    ORACLE_RECORDS
    + """, texts AS (SELECT id, url, CAST(warc_record_size AS VARCHAR) AS warc_record_size, '["' || mime_type || '"]' AS topics,
  '{"code":"' || response_code || '"}' AS http_headers FROM rec)
UNPIVOT (SELECT id AS row, url, warc_record_size, topics, http_headers FROM texts)
ON url, warc_record_size, topics, http_headers INTO NAME "column" VALUE value"""
)
def cell_values(spark, sf_dir):
    rows = records(spark, sf_dir).select(
        F.col("id").alias("key"),
        "url",
        "warc_record_size",
        F.array("mime_type").alias("topics"),
        F.create_map(F.lit("code"), "response_code").alias("http_headers"),
    )
    return output.cells(rows)


_SEEN = " (drop_reason IS NULL OR drop_reason = 'mime type')"


@query(
    ORACLE_GATED
    + f""" SELECT DISTINCT harvest_id AS hid, harvest_type AS type, harvest_date AS date FROM gated
WHERE {_SEEN} AND harvest_id NOT IN ('', 'CZ-2015-12')
UNION ALL SELECT 'CZ-2015-12', 'known', 'long ago'"""
)
def harvest_registry(spark, sf_dir):
    known = spark.sql("SELECT 'CZ-2015-12' AS hid, 'known' AS type, 'long ago' AS date")
    gated = gates.with_gates(records(spark, sf_dir))
    return registry.register_harvests(registry.registered(gated), known)


@query(
    ORACLE_GATED
    + f""" SELECT 'run-1' AS run_id, '--all' AS cmd_args, 1000::BIGINT AS t_started, 2000::BIGINT AS t_finished,
  'finished' AS operation_status,
  count(*) FILTER (WHERE drop_reason IS NULL AND warc_offset % 7000 <> 0) AS records_processed,
  count(*) FILTER (WHERE drop_reason IS NULL AND warc_offset % 7000 = 0) AS records_failed,
  (SELECT string_agg(h, ',' ORDER BY h) FROM (SELECT DISTINCT harvest_id AS h FROM gated WHERE {_SEEN} AND harvest_id <> ''))
    AS harvests FROM gated"""
)
def run_summary(spark, sf_dir):
    gated = gates.with_gates(records(spark, sf_dir))
    counts = registry.run_counts(gated, F.col("warc_offset") % 7000 == 0)
    row = registry.run_row(counts, "run-1", "--all", 1000, 2000, "finished")
    return row.withColumn("harvests", F.array_join("harvests", ","))


@query(ORACLE_RECORDS + " SELECT DISTINCT harvest_id FROM rec WHERE harvest_id <> ''")
def run_harvests(spark, sf_dir):
    return registry.run_harvests(records(spark, sf_dir))


# The greatest key is asked for, so it comes from the data.
@query("SELECT url AS key, page_id FROM pages WHERE url = (SELECT max(url) FROM pages)")
def point_get(spark, sf_dir):
    stored = table(spark, sf_dir, "pages").select(F.col("url").alias("key"), "page_id")
    key = stored.agg(F.max("key")).first()[0]
    return registry.get_row(stored, key)


@query("SELECT url AS key, page_id FROM pages WHERE starts_with(url, 'https://m.')")
def prefix_scan(spark, sf_dir):
    return registry.prefix_scan(table(spark, sf_dir, "pages").select(F.col("url").alias("key"), "page_id"), "https://m.")


# Versions of cells: the row is a source, the column a language, and every document a version. One cell is hot.
_VERSIONS = """versions AS (
  SELECT CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE source END AS row, CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE lang END AS col,
    md5(text) AS value, doc_id AS version FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY row, col ORDER BY version DESC) AS nth FROM versions)"""


def _versions(spark, sf_dir):
    hot = F.col("doc_id") % 3 == 0
    return table(spark, sf_dir, "documents").select(
        F.when(hot, "hot").otherwise(F.col("source")).alias("row"),
        F.when(hot, "en").otherwise(F.col("lang")).alias("col"),
        F.md5("text").alias("value"),
        F.col("doc_id").alias("version"),
    )


@query(f"WITH {_VERSIONS} SELECT row, col, value, version, nth FROM placed WHERE nth <= 100")
def cell_versions(spark, sf_dir):
    return registry.cell_history(_versions(spark, sf_dir)).withColumn("nth", F.col("nth").cast("bigint"))


@query(f"WITH {_VERSIONS} SELECT row, col, value, version FROM versions WHERE row = 'hot' AND col = 'en'")
def cell_history_of_one(spark, sf_dir):
    return registry.cell_versions(_versions(spark, sf_dir), "hot", "en")


@query(f"WITH {_VERSIONS} SELECT row, col, value, version FROM placed WHERE nth <= 5")
def version_retention(spark, sf_dir):
    return registry.keep_versions(_versions(spark, sf_dir), 5).drop("nth")
