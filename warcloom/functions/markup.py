"""HTML expressions over the text of a page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.fixed_values import BLOCK_TAGS, EMBEDDED_TAGS, VOID_TAGS
from warcloom.functions.binding import let
from warcloom.functions.literals import empty_strings
from warcloom.functions.texts import decode_entities, normalise, squeeze
from warcloom.functions.urls import has_scheme_and_host, resolve

# What stands between a tag's name and its end. A ">" in quotes does not end it, unless a quote is never closed; a "<"
# outside quotes does, as the tag is then no tag. So no "<" looks beyond the next, and repeated groups are possessive,
# which the engine runs as loops: time is linear in the page, and no page is too deep.
_INSIDE = r"""(?:"[^"]*+"|'[^']*+'|[^'"<>])"""
_END = rf"(?:{_INSIDE}*+>|[^<>]*+>)"
_TAG_REST = rf"/?[a-zA-Z!?]{_END}"
TAG = f"<{_TAG_REST}"

# Marks put in place of tags while a page is cut into blocks.
BLOCK, LINK_START, LINK_END = "\u0001", "\u0002", "\u0003"


def _any_of(*rests: str) -> str:
    """Pattern of what may follow one `<`, which is looked for first: most of a page is no markup."""
    return f"(?is)<(?:{'|'.join(rests)})"


def _element(name: str) -> str:
    """An element with its content, to the end of the page if it is not closed; without its first `<`."""
    return rf"{name}\b{_END}.*?(?:</{name}\s*>|\z)"


def _content(name: str) -> str:
    """What stands before the end tag of an element; not another such element, so that no two starts look at the same text."""
    return rf"(?:[^<]++|<(?!/{name}\s*>|{name}\b))*+"


def _closed_element(name: str) -> str:
    """An element with its content, or its tag alone if it is not closed before the next of its kind."""
    return rf"{name}\b{_END}(?:{_content(name)}</{name}\s*>)?"


# The end tag of a head may be left out: it also ends where the body, or a first block, begins.
_HEAD = rf"head\b{_END}.*?(?:</head\s*>|(?=<(?:{'|'.join(BLOCK_TAGS)})[\s/>])|\z)"


def _without(text: Column, *characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def clean(html: Column) -> Column:
    """A page without comments, scripts and styles."""
    pattern = _any_of(r"!--.*?(?:-->|\z)", _element("script"), _element("style"))
    return F.regexp_replace(_without(html, BLOCK, LINK_START, LINK_END), pattern, "")


def visible_markup(cleaned: Column) -> Column:
    """All text of a cleaned page, joined without separators, its references not yet decoded.

    Embedded objects and form controls are left out.
    """
    return F.regexp_replace(cleaned, _any_of(*map(_closed_element, EMBEDDED_TAGS), _TAG_REST), "")


def title_markup(cleaned: Column) -> Column:
    """Raw text of the first title that has any, or null."""
    return F.nullif(F.regexp_extract(cleaned, rf"(?is)<title\b{_END}([^<]+)", 1), F.lit(""))


def _direct_texts(inner: Column) -> Column:
    """Text nodes outside nested elements, one entry per node."""
    pieces = F.regexp_extract_all(inner, F.lit(rf"{TAG}|<?[^<]+|<"), F.lit(0))
    void = "|".join(VOID_TAGS)

    def step(state: Column, piece: Column) -> Column:
        is_tag = piece.rlike(f"^{TAG}$")
        opens = is_tag & piece.rlike("^<[a-zA-Z]") & ~piece.rlike(rf"(?i)^<(?:{void})\b|/>$")
        closes = is_tag & piece.startswith("</") & ~piece.rlike(rf"(?i)^</(?:{void})\b")
        depth = state["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        texts = F.when(~is_tag & (state["depth"] == 0), F.array_append(state["texts"], piece)).otherwise(
            state["texts"]
        )
        return F.struct(depth.alias("depth"), texts.alias("texts"))

    start = F.struct(F.lit(0).alias("depth"), empty_strings().alias("texts"))
    nested = F.aggregate(pieces, start, step, lambda state: state["texts"])
    return F.when(inner.contains("<"), nested).otherwise(F.array(inner))


def headlines(cleaned: Column) -> Column:
    """All h1, then all h2, ... h6, as normalised direct text, empty ones left out."""

    def inner(page: Column, level: int) -> Column:
        return F.regexp_extract_all(page, F.lit(rf"(?is)<h{level}\b{_END}({_content(f'h{level}')})</h{level}\s*>"), F.lit(1))

    elements = let(cleaned, lambda page: F.concat(*(inner(page, level) for level in range(1, 7))))
    texts = F.flatten(F.transform(elements, _direct_texts))
    return F.filter(F.transform(texts, normalise), lambda text: text != "")


def hrefs(cleaned: Column) -> Column:
    """Non-empty `href` values of all `a` elements, in order, repeats kept."""
    tags = F.regexp_extract_all(cleaned, F.lit(rf"(?is)<a\s{_END}"), F.lit(0))
    # quoted values are passed over, so nothing within them is an attribute; the first href of a tag counts
    attribute = r"""(?is)\shref\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+)|"[^"]*"|'[^']*'"""

    def first(tag: Column) -> Column:
        return F.get(F.filter(F.regexp_extract_all(tag, F.lit(attribute), F.lit(1)), lambda raw: raw != ""), F.lit(0))

    found = F.filter(F.transform(tags, first), lambda raw: raw.isNotNull())
    values = F.transform(found, lambda raw: F.trim(decode_entities(F.regexp_replace(raw, "^[\"']|[\"']$", ""))))
    return F.filter(values, lambda value: value != "")


def absolute_links(cleaned: Column, url: Column) -> Column:
    """References of a page in absolute form; those without scheme and host are dropped."""
    resolved = let(url, lambda base: F.transform(hrefs(cleaned), lambda reference: resolve(reference, base)))
    return F.filter(resolved, has_scheme_and_host)


def block_markup(cleaned: Column) -> Column:
    """Body of a cleaned page with marks for tags: where a block begins, where a link begins and ends."""
    without_head = F.regexp_replace(cleaned, _any_of(_HEAD, *map(_closed_element, EMBEDDED_TAGS)), "")
    block_tag = rf"/?(?:{'|'.join(BLOCK_TAGS)})(?:>|[\s/]{_END})"
    blocks = F.regexp_replace(without_head, _any_of(block_tag, r"br\s*/?>\s*<br\s*/?>"), BLOCK)
    links = F.regexp_replace(blocks, rf"(?i)<a(?:>|\s{_END})", LINK_START)
    links = F.regexp_replace(links, r"(?i)</a\s*>", LINK_END)
    return F.regexp_replace(F.regexp_replace(links, r"(?i)<br\s*/?>", " "), TAG, "")


def marked_blocks(marked: Column) -> Column:
    """Blocks of a marked text, as an array of struct<text, link_text>; blocks without text are left out.

    A link that spans blocks is closed and opened again at every block border, so each block can be measured alone.
    """
    runs = F.regexp_extract_all(
        marked, F.lit(f"{LINK_START}[^{LINK_START}{LINK_END}]*|[^{LINK_START}]+"), F.lit(0)
    )
    reopened = F.transform(
        runs,
        lambda run: F.when(
            run.startswith(LINK_START),
            F.concat(F.replace(run, F.lit(BLOCK), F.lit(LINK_END + BLOCK + LINK_START)), F.lit(LINK_END)),
        ).otherwise(_without(run, LINK_END)),
    )
    link = f"{LINK_START}([^{LINK_END}]*){LINK_END}"
    blocks = F.transform(
        F.split(F.array_join(reopened, ""), BLOCK),
        lambda block: F.struct(
            squeeze(_without(block, LINK_START, LINK_END)).alias("text"),
            squeeze(F.array_join(F.regexp_extract_all(block, F.lit(link), F.lit(1)), "")).alias("link_text"),
        ),
    )
    return F.filter(blocks, lambda block: block["text"] != "")
