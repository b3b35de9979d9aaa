"""Character sets of byte payloads: marks, declarations, guesses, decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.fixed_values import (
    BYTE_ORDER_MARKS,
    CHARSET_ALIASES,
    CZECH_LETTERS,
    DEFAULT_CHARSETS,
    META_CHARSET_PATTERN,
    XML_DECLARATION_PATTERN,
    XML_ENCODING_PATTERN,
)
from warcloom.functions.binding import let
from warcloom.functions.headers import charset_parameter
from warcloom.functions.literals import string_map

# the intersection keeps other ASCII characters from being compared with every accented letter
_CZECH = f"[a-zA-Z[[^\\x00-\\x7f]&&[{CZECH_LETTERS}]]]+"
REPLACEMENT = "�"


def bom_charset(content: Column) -> Column:
    """Charset named by a byte order mark, or null."""
    head = F.hex(F.substring(content, 1, 4))
    chosen = F.lit(None).cast("string")
    for mark, name in reversed(BYTE_ORDER_MARKS):
        chosen = F.when(head.startswith(mark), F.lit(name)).otherwise(chosen)
    return chosen


def normalised_name(charset: Column) -> Column:
    return F.regexp_replace(F.lower(charset), "[^a-z0-9]+", "_")


def java_charset(charset: Column) -> Column:
    """Name under which Spark decodes a charset; null for unknown names."""
    aliases = {alias: java for java, known in CHARSET_ALIASES.items() for alias in known.split()}
    return F.element_at(string_map(aliases | {"utf_8_sig": "UTF-8"}), normalised_name(charset))


def declared_charsets(content: Column, content_type: Column) -> Column:
    """Known charsets declared by HTTP header, `meta` tag and XML declaration: lower case, in this order, distinct."""

    def declared(markup: Column) -> Column:
        return F.array(
            F.lower(charset_parameter(content_type)),
            F.lower(F.regexp_extract(markup, META_CHARSET_PATTERN, 1)),
            F.lower(F.regexp_extract(markup, XML_ENCODING_PATTERN, 1)),
        )

    names = let(F.call_function("decode", content, F.lit("ISO-8859-1")), declared)
    return F.array_distinct(F.filter(names, lambda name: java_charset(name).isNotNull()))


def decode(content: Column, charset: Column) -> Column:
    """Bytes to text; malformed bytes become U+FFFD. A byte order mark is not part of the text."""

    def exact(java: Column, body: Column) -> Column:
        # without a mark, "utf-16" and "utf-32" mean little endian
        return (
            F.when((java == "UTF-16") & ~F.hex(F.substring(body, 1, 2)).isin("FEFF", "FFFE"), F.lit("UTF-16LE"))
            .when((java == "UTF-32") & (F.hex(F.substring(body, 1, 4)) != "0000FEFF"), F.lit("UTF-32LE"))
            .otherwise(java)
        )

    def decoded(body: Column) -> Column:
        chosen = let(java_charset(charset), lambda java: exact(java, body))
        return F.regexp_replace(F.call_function("decode", body, chosen), r"\A\x{FEFF}", "")

    return let(content, decoded)


def decode_errors(text: Column) -> Column:
    """Number of replacement characters."""
    return F.regexp_count(text, F.lit(REPLACEMENT))


def guess_charset(
    content: Column,
    candidates: Column | None = None,
    charsets: list[str] | None = None,
    sample_bytes: int | None = None,
) -> Column:
    """The charset that gives most Czech letters, then fewest errors, then comes first in `charsets`.

    `candidates`, an array column of known names, takes the place of `charsets` for its row. Null for an empty content. The whole content is
    weighed, or its first `sample_bytes`. All decoding stays inside the row, so nothing is exploded or shuffled.
    """
    charsets = DEFAULT_CHARSETS if charsets is None else charsets
    order = F.array(*map(F.lit, charsets))

    def score(text: Column, position: Column) -> Column:
        size = F.nullif(F.length(text), F.lit(0))
        letters = F.length(text) - F.length(F.regexp_replace(text, _CZECH, ""))
        return F.struct(
            (letters / size).alias("letters"),
            (-decode_errors(text) / size).alias("errors"),
            (-position).alias("position"),
        )

    def best(sample: Column, names: Column) -> Column:
        scores = F.transform(names, lambda name, at: let(decode(sample, name), lambda text: score(text, at)))
        usable = F.filter(scores, lambda made: made["letters"].isNotNull())
        return F.get(names, (-F.array_max(usable)["position"]).cast("int"))

    names = order if candidates is None else candidates
    weighed = content if sample_bytes is None else F.substring(content, 1, sample_bytes)
    return let(weighed, lambda sample: let(names, lambda known: best(sample, known)))


def without_xml_declaration(text: Column) -> Column:
    return F.regexp_replace(text, XML_DECLARATION_PATTERN, "")
