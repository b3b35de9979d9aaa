"""From a payload to title, headlines, links, language and plain text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.fixed_values import CHARSET_ALIASES, MAX_HTML_BYTES
from warcloom.functions import charset as cs
from warcloom.functions.binding import let
from warcloom.functions.literals import string_map
from warcloom.functions.markup import absolute_links, clean, headlines, title_markup, visible_markup
from warcloom.functions.texts import decode_entities, normalise
from warcloom.operators.boilerplate import blocks_of, plain_text
from warcloom.operators.gates import usable_html
from warcloom.operators.language import Stoplists, language_of
from warcloom.session import configure


def charset_of(content: Column, content_type: Column) -> Column:
    """struct<charset, origin>; origin is bom, declared, resolved or guessed.

    A byte order mark wins; one declaration is believed; several are resolved, and none is replaced, by a guess.
    """

    def result(charset: Column, origin: str) -> Column:
        return F.struct(charset.alias("charset"), F.lit(origin).alias("origin"))

    def among(body: Column, declared: Column) -> Column:
        first = F.get(declared, F.lit(0))
        # every declared charset is weighed; the first declaration wins a tie
        resolved = F.coalesce(cs.guess_charset(body, F.transform(declared, _default_name)), first)
        return (
            F.when(F.size(declared) == 1, result(first, "declared"))
            .when(F.size(declared) > 1, result(resolved, "resolved"))
            .otherwise(result(cs.guess_charset(body), "guessed"))
        )

    def chosen(body: Column) -> Column:
        declared = let(cs.declared_charsets(body, content_type), lambda names: among(body, names))
        return let(cs.bom_charset(body), lambda mark: F.when(mark.isNotNull(), result(mark, "bom")).otherwise(declared))

    return let(content, chosen)


def with_charset(records: DataFrame, content: str = "content", content_type: str = "content_type") -> DataFrame:
    """Add `charset` and `charset_origin`, see `charset_of`."""
    configure(records.sparkSession)
    found = records.withColumn("_charset", charset_of(F.col(content), F.col(content_type)))
    return found.withColumns({"charset": F.col("_charset.charset"), "charset_origin": F.col("_charset.origin")}).drop(
        "_charset"
    )


def _default_name(declared: Column) -> Column:
    """The name a declared charset has in the default list, so aliases compete with it."""
    names = string_map({java: name for java, name in reversed(list(_default_charsets().items()))})
    return let(declared, lambda own: F.coalesce(F.element_at(names, cs.java_charset(own)), own))


def _default_charsets() -> dict[str, str]:
    aliases = {alias: java for java, known in CHARSET_ALIASES.items() for alias in known.split()}
    return {aliases[name.replace("-", "_")]: name for name in cs.DEFAULT_CHARSETS}


def with_html(records: DataFrame, content: str = "content", limit: int = MAX_HTML_BYTES) -> DataFrame:
    """Add `html`, the decoded payload without XML declaration, and `decode_errors`.

    Both are null for a blank payload and for one above the limit. Needs `charset`.
    """
    configure(records.sparkSession)
    page = let(
        cs.decode(usable_html(F.col(content), limit), F.col("charset")),
        lambda text: F.struct(
            cs.without_xml_declaration(text).alias("html"), cs.decode_errors(text).alias("decode_errors")
        ),
    )
    decoded = records.withColumn("_page", page)
    return decoded.withColumns({"html": F.col("_page.html"), "decode_errors": F.col("_page.decode_errors")}).drop("_page")


def with_cleaned(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add `cleaned`, the page without comments, scripts and styles."""
    return pages.withColumn("cleaned", clean(F.col(html)))


def page_language_of(cleaned: Column, stoplists: Stoplists) -> Column:
    """Language guessed from all visible text of a cleaned page."""
    return language_of(decode_entities(visible_markup(cleaned)), stoplists)


def title_of(cleaned: Column) -> Column:
    return normalise(title_markup(cleaned))


def page_of(html: Column, url: Column, stoplists: Stoplists, block_stoplists: Stoplists) -> Column:
    """struct<language, title, headlines, links, plain_text> of a page; null without html."""

    def page(cleaned: Column, language: Column) -> Column:
        return F.struct(
            language.alias("language"),
            title_of(cleaned).alias("title"),
            headlines(cleaned).alias("headlines"),
            absolute_links(cleaned, url).alias("links"),
            plain_text(blocks_of(cleaned, language, block_stoplists)).alias("plain_text"),
        )

    def of_cleaned(cleaned: Column) -> Column:
        return let(page_language_of(cleaned, stoplists), lambda language: page(cleaned, language))

    return let(html, lambda text: F.when(text.isNotNull(), let(clean(text), of_cleaned)))


def with_page_text(
    pages: DataFrame, stoplists: Stoplists, block_stoplists: Stoplists | None = None, html: str = "html"
) -> DataFrame:
    """Add language, title, headlines, links and plain text of the page in column `html`.

    `stoplists` guess the language, `block_stoplists` (the same by default) weigh blocks. A page without html gets
    nulls. Everything is computed within the row: no shuffle at all between scan and plain text.
    """
    configure(pages.sparkSession)
    lists = stoplists if block_stoplists is None else block_stoplists
    found = pages.withColumn("_page", page_of(F.col(html), F.col("url"), stoplists, lists))
    names = ["language", "title", "headlines", "links", "plain_text"]
    return found.withColumns({name: F.col(f"_page.{name}") for name in names}).drop("_page")
