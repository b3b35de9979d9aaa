"""Words, tokens, sentences, syllables and the reading-ease formula."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from warcloom.fixed_values import ABBREVIATIONS, DEFAULT_LANGUAGE, TOKENIZER_LANGUAGES
from warcloom.functions.binding import let
from warcloom.functions.texts import NOT_SPACE, SPACE, strip_space

# Repeated groups are possessive, which the engine runs as loops, so that no text is too deep.
_NUMBER = r"\p{N}++(?:[.,:]\p{N}++)++"
_RUN = r"[\p{L}\p{M}\p{N}_'\-]+"
TOKEN = rf"{_NUMBER}|{_RUN}|[^\t-\r\x1c-\x20\x85\p{{Z}}\p{{L}}\p{{M}}\p{{N}}_]"
WORD = r"^[\p{L}\p{N}_\-']+$"

# Characters that carry a syllable. A few Czech and Slovak pairs form one syllable; elsewhere any run does.
VOWELS = "aeiouyáéíóúýàèìòùâêîôûäëïöüÿãõåæœøěůąęаеёиоуыэюяіїє"
# the intersection keeps ASCII consonants from being compared with every accented vowel
_VOWEL = f"[aeiouyAEIOUY[[^\\x00-\\x7f]&&[{VOWELS[6:]}{VOWELS[6:].upper()}]]]"
SYLLABLE_RUN = f"{_VOWEL}+"
SYLLABLE_SLAVIC = f"[aeoAEO][uU]|{_VOWEL}"
SLAVIC_LANGUAGES = ["cs", "sk"]
SYLLABLE_LANGUAGES = ["cs", "sk", "en", "de", "pl", "ru", "fr", "es", "it", "pt", "nl", "hu", "uk"]

SENTENCE = NUCLEUS = "\u0001"


def stripped_word(word: Column) -> Column:
    """A word without non-word characters at its ends."""
    return F.regexp_replace(word, r"^[^\p{L}\p{N}]++|(?<![^\p{L}\p{N}])[^\p{L}\p{N}]++$", "")


def normalised_words(text: Column) -> Column:
    """Whitespace-separated words, stripped and in lower case, empty ones left out.

    One pass over the text: from the first to the last word character of every run without whitespace.
    """
    found = F.regexp_extract_all(text, F.lit(rf"[\p{{L}}\p{{N}}](?:{NOT_SPACE}*[\p{{L}}\p{{N}}])?"), F.lit(0))
    return F.transform(found, F.lower)


def tokens(text: Column) -> Column:
    """Words, numbers with their inner signs (3.14, 12:30), and punctuation characters; no text gives an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def tokenizer_language(language: Column) -> Column:
    """Language whose rules apply: Czech for an unknown or unsupported one."""
    return let(language, lambda own: F.when(own.isin(TOKENIZER_LANGUAGES), own).otherwise(F.lit(DEFAULT_LANGUAGE)))


def _boundary(language: str) -> str:
    """Pattern of the end of a sentence with the whitespace after it; what follows is only looked at."""
    listed = "|".join(re.escape(word) for word in ABBREVIATIONS[language].split())
    closing, opening = r"[\"'»”)\]]", r"[\"'„“‘«(\[]"
    start = r"(?:^|[^\p{L}\p{N}])"
    stop = rf"(?<!{start}(?iu:{listed}))(?<!{start}\p{{Lu}})\."
    return (
        rf"(?=[.!?])(?:(?:[!?]{closing}*|\.{closing}+){SPACE}+(?={opening}*[\p{{Lu}}\p{{N}}])"
        rf"|{stop}{SPACE}+(?={opening}*\p{{Lu}}|{opening}+\p{{N}})|(?<!\p{{N}}){stop}{SPACE}+(?=\p{{N}}))"
    )


def _by_language(language: Column, rule: Callable[[str], Column]) -> Column:
    """`rule` of the tokenizer language of a text."""
    chosen = rule(DEFAULT_LANGUAGE)
    for name in TOKENIZER_LANGUAGES:
        if name != DEFAULT_LANGUAGE:
            chosen = F.when(language == name, rule(name)).otherwise(chosen)
    return chosen


def sentences(text: Column, language: Column) -> Column:
    """Sentences of a text.

    A sentence ends at `.`, `!` or `?`, quotes included, before whitespace and an upper-case letter or digit, quoted or
    not; but not after an abbreviation of the language, an initial, or a number before another number.
    """

    def marked(source: Column, lang: Column) -> Column:
        return _by_language(lang, lambda name: F.regexp_replace(source, f"({_boundary(name)})", f"$1{SENTENCE}"))

    found = let(tokenizer_language(language), lambda lang: let(text, lambda source: marked(source, lang)))
    pieces = F.transform(F.split(F.coalesce(found, F.lit("")), SENTENCE), strip_space)
    return F.filter(pieces, lambda piece: piece != "")


def sentence_count(text: Column, language: Column) -> Column:
    """Number of `sentences`, without making them: a text that is not blank has one more than it has borders."""

    def count(source: Column, lang: Column) -> Column:
        borders = _by_language(lang, lambda name: F.regexp_count(source, F.lit(_boundary(name))))
        return F.when(source.rlike(NOT_SPACE), borders + 1).otherwise(0)

    return let(tokenizer_language(language), lambda lang: let(text, lambda source: count(source, lang)))


def valid_words(token_array: Column) -> Column:
    """Tokens made of word characters, hyphens and apostrophes only."""
    return F.filter(token_array, lambda token: token.rlike(WORD))


def syllable_language(language: Column) -> Column:
    """Language whose syllable rule applies: Czech for an unknown or unsupported one."""
    return let(language, lambda own: F.when(own.isin(SYLLABLE_LANGUAGES), own).otherwise(F.lit(DEFAULT_LANGUAGE)))


def words_of(text: Column) -> Column:
    """The valid words among the tokens of a text, without making the other tokens."""

    def found(source: Column) -> Column:
        runs = F.regexp_extract_all(source, F.lit(f"{_NUMBER}|{_RUN}"), F.lit(0))
        return F.when(source.rlike(r"\p{M}|\p{N}[.,:]\p{N}"), valid_words(runs)).otherwise(runs)

    return let(F.coalesce(text, F.lit("")), found)


def syllable_count(words: Column, language: Column) -> Column:
    """Syllables of all words: vowel groups, at least one for every part between hyphens.

    Words are joined once, vowel groups become marks and all other letters go; so lengths give the counts, and no word
    leaves its row: no shuffle, and no hot word.
    """

    def marks(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(NUCLEUS), F.lit("")))

    def total(bare: Column) -> Column:
        # a part keeps one mark when runs of marks are squeezed, or none
        parts = F.length(F.replace(bare, F.lit(NUCLEUS), F.lit(""))) + 1
        return marks(bare) + parts - marks(F.regexp_replace(bare, f"{NUCLEUS}+", NUCLEUS))

    def of_parts(parts: Column) -> Column:
        slavic = syllable_language(language).isin(SLAVIC_LANGUAGES)
        marked = F.when(slavic, F.regexp_replace(parts, SYLLABLE_SLAVIC, NUCLEUS)).otherwise(
            F.regexp_replace(parts, SYLLABLE_RUN, NUCLEUS)
        )
        bare = F.regexp_replace(marked, f"[^{NUCLEUS}|]+", "")
        return F.when(parts == "", F.lit(0)).otherwise(let(bare, total))

    # no words give an empty string, which a word never does
    return let(F.regexp_replace(F.array_join(words, "|"), "-+", "|"), of_parts)


def reading_ease(n_sentences: Column, n_words: Column, n_syllables: Column) -> Column:
    """Flesch Reading Ease; null without sentences or words."""
    words, sentence_total = F.nullif(n_words, F.lit(0)), F.nullif(n_sentences, F.lit(0))
    return 206.835 - 1.015 * (words / sentence_total) - 84.6 * (n_syllables / words)


def text_statistics(
    text: Column, language: Column, token_array: Column | None = None, sentence_array: Column | None = None
) -> Column:
    """struct<n_sentences, n_words, n_syllables, reading_ease> of a text; no text gives 0, 0, 0 and null.

    Token and sentence arrays that are there already are used.
    """

    def counted(source: Column, lang: Column) -> Column:
        made_words = words_of(source)
        made_count = sentence_count(source, lang)
        own_words = made_words if token_array is None else F.coalesce(valid_words(token_array), made_words)
        n_sentences = (
            made_count
            if sentence_array is None
            else F.when(sentence_array.isNotNull(), F.size(sentence_array)).otherwise(made_count)
        )
        counts = let(
            own_words,
            lambda words: F.struct(
                F.coalesce(n_sentences, F.lit(0)).alias("n_sentences"),
                F.size(words).alias("n_words"),
                syllable_count(words, lang).alias("n_syllables"),
            ),
        )
        return let(
            counts,
            lambda n: F.struct(
                n["n_sentences"].alias("n_sentences"),
                n["n_words"].alias("n_words"),
                n["n_syllables"].alias("n_syllables"),
                reading_ease(n["n_sentences"], n["n_words"], n["n_syllables"]).alias("reading_ease"),
            ),
        )

    return let(language, lambda lang: let(text, lambda source: counted(source, lang)))
