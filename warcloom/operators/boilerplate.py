"""Main text of a page: blocks, their features, classes, and the fallback settings.

A page stays one row: its blocks are an array of structs and its classes an array of strings. So a page is never
shuffled for its blocks, and neighbours are a slice of at most `max_good_distance` entries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.fixed_values import BOILERPLATE_BASE, BOILERPLATE_FALLBACKS, DEFAULT_LANGUAGE
from warcloom.functions.binding import let
from warcloom.functions.literals import count_listed
from warcloom.functions.markup import block_markup, marked_blocks
from warcloom.functions.texts import decode_entities
from warcloom.operators.language import Stoplists

GOOD, NEARGOOD, SHORT, BAD = "good", "neargood", "short", "bad"


def blocks_of(cleaned: Column, language: Column, stoplists: Stoplists) -> Column:
    """Blocks of a cleaned page: array of struct<text, length, link_length, n_words, n_stopwords>.

    Stopwords are those of the page's language, of `DEFAULT_LANGUAGE` if that is null; a language without stoplist
    gives null.
    """

    def n_stopwords(lang: Column, words: Column) -> Column:
        counted = F.lit(0)
        for name, listed in stoplists.items():
            counted = F.when(lang == name, count_listed(words, listed, "lower(word)")).otherwise(counted)
        return counted

    def features(block: Column, lang: Column) -> Column:
        return let(
            F.split(block["text"], " "),
            lambda words: F.struct(
                block["text"].alias("text"),
                F.length(block["text"]).alias("length"),
                F.length(block["link_text"]).alias("link_length"),
                F.size(words).alias("n_words"),
                n_stopwords(lang, words).alias("n_stopwords"),
            ),
        )

    def made(lang: Column) -> Column:
        cut = marked_blocks(decode_entities(block_markup(cleaned)))
        return F.when(lang.isin(list(stoplists)), F.transform(cut, lambda block: features(block, lang)))

    if not stoplists:
        return F.lit(None).cast("array<struct<text:string,length:int,link_length:int,n_words:int,n_stopwords:int>>")
    return let(F.coalesce(language, F.lit(DEFAULT_LANGUAGE)), made)


def context_free(blocks: Column, setting: dict) -> Column:
    """Class of every block by its own features."""

    def label(block: Column) -> Column:
        link_density = block["link_length"] / block["length"]
        stop_density = block["n_stopwords"] / block["n_words"]
        by_length = F.when(block["length"] > setting["length_high"], GOOD).otherwise(NEARGOOD)
        return (
            F.when(link_density > setting["max_link_density"], BAD)
            .when(block["text"].contains("©") | block["text"].contains("&copy"), BAD)
            .when(block["length"] < setting["length_low"], F.when(block["link_length"] > 0, BAD).otherwise(SHORT))
            .when(stop_density >= setting["stopwords_high"], by_length)
            .when(stop_density >= setting["stopwords_low"], NEARGOOD)
            .otherwise(BAD)
        )

    return F.transform(blocks, label)


def _before(classes: Column, at: Column, distance: int, wanted: list[str]) -> Column:
    window = F.slice(classes, F.greatest(at - distance + 1, F.lit(1)), F.least(at, F.lit(distance)))
    return F.get(F.reverse(F.filter(window, lambda c: c.isin(wanted))), F.lit(0))


def _after(classes: Column, at: Column, distance: int, wanted: list[str]) -> Column:
    window = F.slice(classes, at + 2, F.lit(distance))
    return F.get(F.filter(window, lambda c: c.isin(wanted)), F.lit(0))


def revise_short(classes: Column, distance: int) -> Column:
    """Short blocks take the class of their neighbours; no neighbour within `distance` counts as bad."""

    def revise(known: Column, own: Column, at: Column) -> Column:
        strict = [F.coalesce(side(known, at, distance, [GOOD, BAD]), F.lit(BAD)) for side in (_before, _after)]
        loose = [side(known, at, distance, [GOOD, BAD, NEARGOOD]) for side in (_before, _after)]
        both_good = (strict[0] == GOOD) & (strict[1] == GOOD)
        both_bad = (strict[0] == BAD) & (strict[1] == BAD)
        nearly = [(one == BAD) & (other == NEARGOOD) for one, other in zip(strict, loose)]
        better = both_good | (~both_bad & F.coalesce(nearly[0] | nearly[1], F.lit(False)))
        return F.when(own != SHORT, own).when(better, GOOD).otherwise(BAD)

    return let(classes, lambda known: F.transform(known, lambda own, at: revise(known, own, at)))


def revise_neargood(classes: Column, distance: int) -> Column:
    """Nearly good blocks become bad between bad neighbours, good otherwise."""

    def revise(known: Column, own: Column, at: Column) -> Column:
        good = [F.coalesce(side(known, at, distance, [GOOD, BAD]) == GOOD, F.lit(False)) for side in (_before, _after)]
        return F.when(own != NEARGOOD, own).when(good[0] | good[1], GOOD).otherwise(BAD)

    return let(classes, lambda known: F.transform(known, lambda own, at: revise(known, own, at)))


def classes_of(blocks: Column, setting: dict = BOILERPLATE_BASE) -> Column:
    """Final class of every block, as an array parallel to `blocks`."""
    distance = setting["max_good_distance"]
    return revise_neargood(revise_short(context_free(blocks, setting), distance), distance)


def with_fallback(
    blocks: Column, base: dict = BOILERPLATE_BASE, fallbacks: list[dict] = BOILERPLATE_FALLBACKS
) -> Column:
    """struct<setting, classes>: classes by the first setting that finds a good block, and its number (0 is the base).

    Every fallback starts from the base, and is only computed for pages on which nothing was good before. The last one
    stays, whatever it finds.
    """
    settings = [base] + [base | update for update in fallbacks]

    def attempt(known: Column, number: int) -> Column:
        classes = classes_of(known, settings[number])
        if number == len(settings) - 1:
            return F.struct(F.lit(number).alias("setting"), classes.alias("classes"))
        return let(
            classes,
            lambda found: F.when(
                F.array_contains(found, GOOD), F.struct(F.lit(number).alias("setting"), found.alias("classes"))
            ).otherwise(attempt(known, number + 1)),
        )

    return let(blocks, lambda known: F.when(known.isNotNull(), attempt(known, 0)))


def plain_text(blocks: Column) -> Column:
    """Good blocks in page order, one per line."""

    def joined(known: Column, classes: Column) -> Column:
        good = F.filter(known, lambda block, at: F.get(classes, at) == GOOD)
        return F.array_join(F.transform(good, lambda block: block["text"]), "\n")

    return let(blocks, lambda known: let(with_fallback(known)["classes"], lambda classes: joined(known, classes)))
