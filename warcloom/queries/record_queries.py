"""Records: headers, fields, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from warcloom.functions import headers
from warcloom.functions.urls import url_key as url_key_of
from warcloom.operators import gates
from warcloom.operators import records as rec
from warcloom.operators.page_text import with_html
from warcloom.queries.catalog import query, table
from warcloom.queries.inputs import CRLF, ORACLE_GATED, ORACLE_RECORDS, records, scanned
from warcloom.sources.listing import distinct_ids


@query(
    ORACLE_RECORDS
    + """ SELECT page_id, response_code AS status, content_type, location,
    CAST(1 + CASE WHEN content_type IS NULL THEN 0 ELSE 1 END + CASE WHEN location IS NULL THEN 0 ELSE 1 END AS BIGINT)
      AS n_headers,
    'last ' || warc_type AS repeated FROM rec"""
)
def header_map(spark, sf_dir):
    # one header comes twice, and its last value is folded over two lines
    repeated = F.concat(
        F.col("http_block"),
        F.lit(f"{CRLF}X-Twice: first{CRLF}X-Twice: last{CRLF} "),
        F.regexp_extract("rec_block", "WARC-Type: ([a-z]+)", 1),
    )
    blocks = scanned(spark, sf_dir).select("page_id", repeated.alias("block"))
    parsed = blocks.select(
        "page_id", headers.header_map(F.col("block")).alias("h"), headers.status_code(F.col("block")).alias("status")
    )
    return parsed.select(
        "page_id",
        "status",
        F.try_element_at("h", F.lit("Content-Type")).alias("content_type"),
        F.try_element_at("h", F.lit("Location")).alias("location"),
        F.size("h").cast("bigint").alias("n_headers"),
        F.try_element_at("h", F.lit("X-Twice")).alias("repeated"),
    )


@query(ORACLE_RECORDS + " SELECT mime_type, count(*) AS n_records FROM rec GROUP BY mime_type")
def mime_parse(spark, sf_dir):
    return records(spark, sf_dir).groupBy("mime_type").agg(F.count(F.lit(1)).alias("n_records"))


@query("SELECT page_id, to_base64(encode(html)) AS content, true AS same, '' AS broken FROM pages")
def content_base64(spark, sf_dir):
    encoded = table(spark, sf_dir, "pages").select(
        "page_id",
        F.encode("html", "UTF-8").alias("bytes"),
        rec.content_base64(F.encode("html", "UTF-8")).alias("content"),
    )
    return encoded.select(
        "page_id",
        "content",
        (rec.content_bytes(F.col("content")) == F.col("bytes")).alias("same"),
        F.decode(rec.content_bytes(F.concat(F.lit("?"), F.col("content"))), "UTF-8").alias("broken"),
    )


@query(
    ORACLE_RECORDS
    + """ SELECT id, url, warc_date AS timestamp, mime_type, response_code, refers_to, warc_filename, warc_offset,
    warc_record_size, harvest_id, redirect_url, is_revisit FROM rec"""
)
def records_normalize(spark, sf_dir):
    return records(spark, sf_dir).select(
        "id",
        "url",
        "timestamp",
        "mime_type",
        "response_code",
        "refers_to",
        "warc_filename",
        "warc_offset",
        "warc_record_size",
        "harvest_id",
        "redirect_url",
        "is_revisit",
    )


@query(
    r"""WITH parts AS (
  SELECT page_id, url, regexp_extract(lower(trim(url)), '^([a-z][a-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?',
    ['scheme', 'host', 'path', 'query']) AS p FROM pages
), hosts AS (
  SELECT page_id, url, p.scheme AS scheme, p.query AS query, rtrim(p.path, '/') AS path,
    regexp_replace(regexp_replace(p.host, '^[^@]*@', ''), '^www[0-9]*\.', '') AS host FROM parts
)
SELECT page_id, url, scheme || '://'
    || CASE scheme WHEN 'http' THEN regexp_replace(host, ':80$', '') ELSE regexp_replace(host, ':443$', '') END
    || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN query = '' THEN ''
       ELSE '?' || array_to_string(list_sort(string_split(query, '&')), '&') END AS urlkey
FROM hosts"""
)
def url_key(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", url_key_of(F.col("url")).alias("urlkey"))


@query(
    ORACLE_RECORDS
    + """ SELECT warc_filename, harvest_id AS name, harvest_type AS type, harvest_date AS date, count(*) AS n_records
    FROM rec GROUP BY ALL"""
)
def harvest_info(spark, sf_dir):
    info = rec.harvest_info(F.col("warc_filename"))
    named = records(spark, sf_dir).select(
        "warc_filename", info["name"].alias("name"), info["type"].alias("type"), info["date"].alias("date")
    )
    return named.groupBy("warc_filename", "name", "type", "date").agg(F.count(F.lit(1)).alias("n_records"))


@query(ORACLE_RECORDS + " SELECT page_id, id, raw_id IS NULL AS derived FROM rec")
def record_id(spark, sf_dir):
    raw = F.try_element_at("rec_headers", F.lit("WARC-Record-ID"))
    return records(spark, sf_dir).select("page_id", "id", raw.isNull().alias("derived"))


@query(ORACLE_RECORDS + " SELECT page_id, refers_to, is_revisit FROM rec")
def revisit_flag(spark, sf_dir):
    return records(spark, sf_dir).select("page_id", "refers_to", "is_revisit")


@query(ORACLE_RECORDS + " SELECT page_id, response_code, redirect_url FROM rec WHERE location IS NOT NULL")
def redirect_target(spark, sf_dir):
    located = F.try_element_at("http_headers", F.lit("Location")).isNotNull()
    return records(spark, sf_dir).filter(located).select("page_id", "response_code", "redirect_url")


@query(ORACLE_RECORDS + " SELECT page_id, raw_size, warc_record_size, warc_offset FROM rec")
def int_fields(spark, sf_dir):
    raw = F.try_element_at("rec_headers", F.lit("Content-Length"))
    return records(spark, sf_dir).select("page_id", raw.alias("raw_size"), "warc_record_size", "warc_offset")


@query(ORACLE_RECORDS + " SELECT id, warc_type FROM rec WHERE warc_type IN ('response', 'revisit')")
def filter_record_type(spark, sf_dir):
    return records(spark, sf_dir).filter(gates.wanted_type(F.col("warc_type"))).select("id", "warc_type")


@query(ORACLE_RECORDS + " SELECT id, warc_record_size FROM rec WHERE warc_record_size <= 100000000")
def filter_size(spark, sf_dir):
    return records(spark, sf_dir).filter(gates.wanted_size(F.col("warc_record_size"))).select("id", "warc_record_size")


@query(
    ORACLE_RECORDS
    + """ SELECT id, url FROM rec WHERE id IN (
    SELECT 'urn:uuid:00000000-0000-4000-8000-' || lpad(CAST(page_id AS string), 12, '0') FROM pages
    WHERE html LIKE '%lang="en"%')"""
)
def only_ids(spark, sf_dir):
    # the list file names the English pages, with blanks, empty lines and repeats
    listed = table(spark, sf_dir, "pages").filter(F.col("html").contains('lang="en"'))
    name = F.concat(F.lit("urn:uuid:00000000-0000-4000-8000-"), F.lpad(F.col("page_id").cast("string"), 12, "0"))
    lines = listed.select(F.explode(F.array(F.concat(F.lit("  "), name), F.lit(" "), name)).alias("value"))
    return gates.only_ids(records(spark, sf_dir), distinct_ids(lines)).select("id", "url")


@query(ORACLE_RECORDS + " SELECT id, response_code FROM rec WHERE regexp_full_match(response_code, '2[0-9][0-9]')")
def status_filter(spark, sf_dir):
    return records(spark, sf_dir).filter(gates.passes_filters()).select("id", "response_code")


@query(
    ORACLE_RECORDS
    + """ SELECT page_id, CASE WHEN regexp_full_match(mime_type, '[a-z]+/[a-zA-Z0-9.+-]+') THEN ''
    ELSE 'pattern mime_type' END AS invalid_rules FROM rec"""
)
def schema_validate(spark, sf_dir):
    checked = records(spark, sf_dir)
    return checked.select(
        "page_id", F.array_join(gates.invalid_rules(checked.columns), ", ").alias("invalid_rules")
    )


@query(ORACLE_RECORDS + " SELECT page_id, mime_type, mime_group FROM rec")
def mime_route(spark, sf_dir):
    return records(spark, sf_dir).select(
        "page_id", "mime_type", gates.mime_group(F.col("mime_type")).alias("mime_group")
    )


@query(
    r"""SELECT page_id, html <> '' AS is_html, octet_length(encode(html)) AS n_bytes,
    CASE WHEN octet_length(encode(html)) <= 3000 THEN length(html) END AS n_chars_limited,
    CAST(NULL AS BIGINT) AS n_chars_blank FROM pages"""
)
def html_guards(spark, sf_dir):
    # the limit is lowered to 3,000 bytes so that it cuts real pages; blank payloads are made of the page length
    payload = F.encode("html", "UTF-8")
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        payload.alias("content"),
        F.encode(F.repeat(F.lit(" \n"), F.length("html")), "UTF-8").alias("blank"),
        F.lit("utf-8").alias("charset"),
    )
    limited = with_html(pages, limit=3000).withColumnRenamed("html", "limited").drop("decode_errors")
    blank = with_html(limited, "blank")
    return blank.select(
        "page_id",
        gates.html_within_limits(F.col("content")).alias("is_html"),
        F.octet_length("content").cast("bigint").alias("n_bytes"),
        F.length("limited").cast("bigint").alias("n_chars_limited"),
        F.length("html").cast("bigint").alias("n_chars_blank"),
    )


@query(ORACLE_GATED + " SELECT coalesce(drop_reason, 'kept') AS reason, count(*) AS n_records FROM gated GROUP BY 1")
def gate_report(spark, sf_dir):
    return gates.gate_report(gates.with_gates(records(spark, sf_dir)))


@query(
    ORACLE_RECORDS
    + """ SELECT page_id, errors FROM (SELECT page_id, concat_ws('; ',
      CASE WHEN raw_id IS NULL THEN 'id: missing, derived from file and offset' END,
      CASE WHEN warc_record_size IS NULL THEN 'warc_record_size: not an integer' END,
      CASE WHEN harvest_id = '' THEN 'harvest_id: file name has another form' END,
      CASE WHEN location IS NOT NULL AND redirect_url IS NULL THEN 'redirect_url: location without redirecting status' END)
      AS errors FROM rec) WHERE errors <> ''"""
)
def error_quarantine(spark, sf_dir):
    return (
        records(spark, sf_dir)
        .filter(F.size("errors") > 0)
        .select("page_id", F.array_join("errors", "; ").alias("errors"))
    )

