"""Header blocks of WARC and HTTP."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.functions.literals import empty_map


def header_map(block: Column) -> Column:
    """Header block to map, without its start line; continuation lines are joined, the last duplicate wins.

    Keys keep their case, and so do later lookups. No block gives an empty map.
    """
    unfolded = F.regexp_replace(block, r"\r?\n([ \t])", "$1")
    lines = F.split(unfolded, r"\r?\n")
    fields = F.filter(F.slice(lines, F.lit(2), F.size(lines)), lambda line: line.contains(":"))
    entries = F.transform(
        fields,
        lambda line: F.struct(
            F.rtrim(F.substring_index(line, ":", 1)).alias("key"),
            F.regexp_replace(F.regexp_replace(line, r"^[^:]*:[ \t]*", ""), r"(?<![ \t])[ \t]++$", "").alias("value"),
        ),
    )
    return F.coalesce(F.map_from_entries(entries), empty_map())


def status_code(block: Column) -> Column:
    """First token after the protocol; the empty string without HTTP headers."""
    return F.coalesce(F.regexp_extract(block, r"^[^ \r\n]+ +([^ \r\n]+)", 1), F.lit(""))


def mime_type(content_type: Column) -> Column:
    """What stands before the first semicolon, trimmed, case kept."""
    return F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1)))


def charset_parameter(content_type: Column) -> Column:
    """The `charset` parameter of a content type, unquoted; null if there is none."""
    value = F.regexp_extract(content_type, r"""(?i);\s*charset\s*=\s*"?([^";]*)""", 1)
    return F.nullif(F.trim(value), F.lit(""))
