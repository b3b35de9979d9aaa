"""Which records go on, and why others do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.fixed_values import (
    LANGUAGE_PATTERN,
    MAX_HTML_BYTES,
    MAX_RECORD_BYTES,
    MIME_GROUPS,
    MIME_TYPE_PATTERN,
    PAGE_TYPES,
    RECORD_FILTERS,
    RECORD_TYPES,
    REQUIRED_FIELDS,
    RESPONSE_CODE_PATTERN,
)
from warcloom.functions.binding import let


UNREADABLE = "unreadable"


def wanted_type(warc_type: Column, types: list[str] = RECORD_TYPES) -> Column:
    return F.coalesce(warc_type.isin(types), F.lit(False))


def wanted_size(size: Column, limit: int = MAX_RECORD_BYTES) -> Column:
    """Size within the limit, which is still allowed; a missing size is not."""
    return F.coalesce(size <= limit, F.lit(False))


def passes_filters(filters: dict[str, str] = RECORD_FILTERS) -> Column:
    """All metadata patterns match from the start of their field; a null field counts as empty."""
    passed = F.lit(True)
    for field, pattern in filters.items():
        passed = passed & F.coalesce(F.col(field), F.lit("")).rlike(f"^(?:{pattern})")
    return passed


# Rules by name, as predicates over a record; a null field fails none but `required`.
def schema_rules(columns: list[str]) -> dict[str, Column]:
    patterns = {
        "mime_type": MIME_TYPE_PATTERN,
        "response_code": RESPONSE_CODE_PATTERN,
        "language": LANGUAGE_PATTERN,
    }
    rules = {f"required {field}": F.col(field).isNotNull() for field in REQUIRED_FIELDS}
    rules |= {f"pattern {field}": F.col(field).rlike(pattern) for field, pattern in patterns.items()}
    rules |= {f"minimum {field}": F.col(field) >= 0 for field in ["warc_offset", "warc_record_size"]}
    rules["enum web_page_type"] = F.col("web_page_type").isin(list(PAGE_TYPES))
    rules["range sentiment"] = F.col("sentiment").between(-1, 1)
    return {name: rule for name, rule in rules.items() if name.split()[1] in columns}


def invalid_rules(columns: list[str]) -> Column:
    """Names of the rules a record breaks, for the rules whose fields are among `columns`."""
    broken = [F.when(~rule, F.lit(name)) for name, rule in schema_rules(columns).items()]
    if not broken:
        return F.expr("cast(array() as array<string>)")
    return F.filter(F.array(*broken), lambda name: name.isNotNull())


def mime_group(mime: Column, groups: dict[str, str] = MIME_GROUPS) -> Column:
    """First group whose pattern matches the start of a MIME type, case ignored; null if none does."""
    chosen = F.lit(None).cast("string")
    for group, pattern in reversed(list(groups.items())):
        chosen = F.when(F.coalesce(mime, F.lit("")).rlike(f"(?i)^(?:{pattern})"), F.lit(group)).otherwise(chosen)
    return chosen


def only_ids(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Records whose ID is listed. An empty list means no restriction.

    IDs are distinct and spread evenly, so the semi join has no hot key; Spark broadcasts the list when it measures it
    small, and shuffles IDs otherwise.
    """
    return records if ids.isEmpty() else records.join(ids.select("id"), "id", "left_semi")


def html_within_limits(content: Column, limit: int = MAX_HTML_BYTES) -> Column:
    """Content that is worth extracting: not blank, not larger than the limit."""
    return usable_html(content, limit).isNotNull()


def usable_html(content: Column, limit: int = MAX_HTML_BYTES) -> Column:
    """Content within the limits, else null."""

    def usable(body: Column) -> Column:
        text = F.call_function("decode", body, F.lit("ISO-8859-1"))
        return F.when((F.octet_length(body) <= limit) & text.rlike(r"[^\t-\r ]"), body)

    return let(content, usable)


def drop_reason(groups: dict[str, str] = MIME_GROUPS, listed: Column | None = None, unreadable: Column | None = None) -> Column:
    """The first gate that stops a record, or null. `listed` tells whether an ID list names it, `unreadable` whether the
    scan could not read it."""
    in_list = F.lit(True) if listed is None else listed
    return (
        F.when(F.lit(False) if unreadable is None else unreadable, UNREADABLE)
        .when(~wanted_type(F.col("warc_type")), "record type")
        .when(~wanted_size(F.col("warc_record_size")), "record size")
        .when(~in_list, "not listed")
        .when(~passes_filters(), "metadata filter")
        .when(F.size("invalid_rules") > 0, "invalid record")
        .when(F.col("mime_group").isNull(), "mime type")
    )


def with_gates(records: DataFrame, groups: dict[str, str] = MIME_GROUPS, listed: Column | None = None) -> DataFrame:
    """Records with `invalid_rules`, `mime_group` and `drop_reason`; nothing is dropped yet."""
    checked = records.withColumns(
        {
            "invalid_rules": invalid_rules(records.columns),
            "mime_group": mime_group(F.col("mime_type"), groups),
        }
    )
    scanned = {"scan_error", "warc_type"} <= set(records.columns)
    unreadable = F.col("scan_error").isNotNull() & F.col("warc_type").isNull() if scanned else None
    return checked.withColumn("drop_reason", drop_reason(groups, listed, unreadable))


def passed(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("drop_reason").isNull()).drop("drop_reason", "invalid_rules")


def gate_report(gated: DataFrame) -> DataFrame:
    """Number of records per drop reason; counted on the map side first, whatever reason prevails."""
    return gated.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_records")
    )
