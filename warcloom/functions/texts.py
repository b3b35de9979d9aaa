"""Characters, whitespace and entities."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.functions.binding import let
from warcloom.functions.literals import string_map

# One Unicode whitespace character, and one that is none, as regular expressions.
SPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
_NO_PLAIN_SPACE = r"[\t-\r\x1c-\x1f\x85[\p{Z}&&[^ ]]]"
NOT_SPACE = r"[^\t-\r\x1c-\x20\x85\p{Z}]"


def squeeze(text: Column) -> Column:
    """Whitespace runs become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(text, f" {SPACE}+|{_NO_PLAIN_SPACE}{SPACE}*", " "))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}++|(?<!{SPACE}){SPACE}++\z", "")


def _code_point(hexadecimal: Column) -> Column:
    """The character of a code point below 0x110000, U+FFFD for others."""
    padded = F.lpad(hexadecimal, 8, "0")
    valid = (F.length(hexadecimal) <= 8) & (padded <= F.lit("0010FFFF")) & (padded > F.lit("00000000"))
    return F.when(valid, F.call_function("decode", F.unhex(padded), F.lit("UTF-32"))).otherwise(F.lit("�"))


def decode_entities(text: Column) -> Column:
    """Named (HTML 4) and numeric character references become characters, each reference once.

    The text is cut at its references, each piece is looked up by itself, and the pieces are joined again, so the work
    grows with the text alone and nothing that was decoded is read as a reference.
    """
    names = string_map({name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"})

    def character(ref: Column) -> Column:
        decimal = F.conv(F.left(F.regexp_extract(ref, "^#0*([0-9]*)$", 1), F.lit(10)), 10, 16)
        hexadecimal = F.upper(F.regexp_extract(ref, "^#[xX]0*([0-9a-fA-F]*)$", 1))
        return (
            F.when(ref.rlike("^#[xX]"), let(hexadecimal, _code_point))
            .when(ref.startswith("#"), let(decimal, _code_point))
            .otherwise(F.element_at(names, ref))
        )

    def piece(own: Column) -> Column:
        reference = F.substring(own, F.lit(2), F.length(own) - 2)
        known = F.coalesce(let(reference, character), own)
        return F.when(own.startswith("&") & own.endswith(";"), known).otherwise(own)

    def decoded(text: Column) -> Column:
        pattern = "(?s)&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);|[^&]+|&"
        pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(pieces, piece), "")).otherwise(text)

    return let(text, decoded)


def normalise(text: Column) -> Column:
    """Text of a title or headline: references decoded (once by a parser, once more by choice), space squeezed."""
    return squeeze(decode_entities(decode_entities(text)))
