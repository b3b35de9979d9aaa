"""Scanned blocks to records of the intermediary format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.fixed_values import REC_HEADER_FIELDS, REDIRECT_STATUS
from warcloom.functions.headers import header_map, mime_type, status_code
from warcloom.functions.urls import url_key
from warcloom.session import configure


def record_id(raw: Column, filename: Column, offset: Column) -> Column:
    """ID without angle brackets. A missing one is derived from file and offset, so a retried task gives it again."""
    digest = F.md5(F.concat_ws("|", F.coalesce(filename, F.lit("")), F.coalesce(offset.cast("string"), F.lit(""))))
    derived = F.concat(
        F.lit("urn:uuid:"),
        F.concat_ws("-", *(F.substring(digest, at, size) for at, size in [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)])),
    )
    return F.when(F.coalesce(raw, F.lit("")) == "", derived).otherwise(F.btrim(raw, F.lit("<>")))


def plain_filename(filename: Column) -> Column:
    return F.regexp_replace(filename, "^file:", "")


def harvest_info(filename: Column) -> Column:
    """struct<name, type, date> from a file name; empty strings where the name has not the usual form."""
    base = F.regexp_extract(filename, r"[^/]*\z", 0)
    pattern = r"^(.+)-(\d{8,})-"
    name = F.regexp_extract(base, pattern, 1)
    return F.struct(
        name.alias("name"),
        F.substring_index(name, "-", 1).alias("type"),
        F.substring(F.regexp_extract(base, pattern, 2), 1, 8).alias("date"),
    )


def integer_field(value: Column) -> Column:
    """Digits become an integer; anything else, and what no bigint holds, is null."""
    text = value.cast("string")
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def redirect_url(location: Column, status: Column) -> Column:
    """Redirection target, for statuses that redirect."""
    return F.when((location != "") & F.coalesce(status, F.lit("")).rlike(REDIRECT_STATUS), location)


def is_revisit(refers_to: Column) -> Column:
    return F.coalesce(refers_to, F.lit("")) != ""


def content_base64(content: Column) -> Column:
    """Payload as one line of base64."""
    return F.regexp_replace(F.base64(content), "[\r\n]", "")


def content_bytes(text: Column) -> Column:
    """Payload from base64; empty bytes if it is missing or broken."""
    return F.coalesce(F.try_to_binary(text, F.lit("base64")), F.expr("X''"))


def normalise(scanned: DataFrame) -> DataFrame:
    """Scanned rows (see `sources.warc.SCHEMA`) to records, one projection after the other, no shuffle.

    Other columns are kept. A row that was only read as an error has no headers; the gates drop it.
    """
    configure(scanned.sparkSession)
    maps = scanned.withColumns(
        {
            "rec_headers": header_map(F.col("rec_block")),
            "http_headers": header_map(F.col("http_block")),
            "response_code": status_code(F.col("http_block")),
        }
    ).drop("rec_block", "http_block")
    raw = {field: F.try_element_at("rec_headers", F.lit(name)) for name, field in REC_HEADER_FIELDS.items()}
    filename = plain_filename(F.col("warc_filename"))
    fields = maps.withColumns(
        raw
        | {
            "warc_type": F.try_element_at("rec_headers", F.lit("WARC-Type")),
            "mime_type": mime_type(F.try_element_at("http_headers", F.lit("Content-Type"))),
            "refers_to": F.btrim(raw["refers_to"], F.lit("<>")),
            "warc_record_size": integer_field(raw["warc_record_size"]),
            "redirect_url": redirect_url(
                F.try_element_at("http_headers", F.lit("Location")), F.col("response_code")
            ),
            "id": record_id(raw["id"], filename, F.col("warc_offset")),
            "warc_filename": filename,
        }
    )
    return fields.withColumns(
        {
            "urlkey": url_key(F.col("url")),
            "harvest_id": harvest_info(F.col("warc_filename"))["name"],
            "is_revisit": is_revisit(F.col("refers_to")),
        }
    )


def normalisation_errors() -> Column:
    """What normalisation had to repair in a record, as an array of messages."""
    size = F.try_element_at("rec_headers", F.lit("Content-Length"))
    raw_id = F.try_element_at("rec_headers", F.lit("WARC-Record-ID"))
    checks = {
        "id: missing, derived from file and offset": F.coalesce(raw_id, F.lit("")) == "",
        "warc_record_size: not an integer": size.isNotNull() & F.col("warc_record_size").isNull(),
        "harvest_id: file name has another form": F.col("harvest_id") == "",
        "redirect_url: location without redirecting status": (
            F.coalesce(F.try_element_at("http_headers", F.lit("Location")), F.lit("")) != ""
        )
        & F.col("redirect_url").isNull(),
    }
    found = F.array(*(F.when(check, F.lit(message)) for message, check in checks.items()), F.col("scan_error"))
    return F.filter(found, lambda message: message.isNotNull())
