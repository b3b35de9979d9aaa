"""Language guess by stopwords, and the stoplists it needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.fixed_values import (
    LANGUAGES,
    MIN_STOPWORD_COUNT,
    MIN_STOPWORD_RATIO,
    STOPLIST_IGNORED,
    STOPLIST_SIZE,
    STOPLIST_STRIP_CHARS,
)
from warcloom.functions.binding import let
from warcloom.functions.literals import count_listed, keep_listed
from warcloom.functions.texts import NOT_SPACE, SPACE
from warcloom.functions.tokens import normalised_words
from warcloom.operators.ranking import top_n_per_group

Stoplists = dict[str, list[str]]


def collect_stoplists(stoplist: DataFrame, order: list[str] = LANGUAGES) -> Stoplists:
    """Rows (lang, word) as `{language: words}`, languages in the given order.

    Stoplists are parameters, a thousand words or so for each language, so they are collected.
    """
    rows = stoplist.select("lang", "word").collect()
    words: dict[str, list[str]] = {}
    for lang, word in rows:
        words.setdefault(lang, []).append(word)
    rank = {lang: position for position, lang in enumerate(order)}
    return {lang: sorted(words[lang]) for lang in sorted(words, key=lambda lang: (rank.get(lang, len(rank)), lang))}


def with_language(
    texts: DataFrame,
    text: str,
    stoplists: Stoplists,
    output: str = "language",
    min_ratio: float = MIN_STOPWORD_RATIO,
    min_count: int = MIN_STOPWORD_COUNT,
) -> DataFrame:
    """Add the language whose stopwords occur most often in a text; null if none occurs often enough.

    A language needs max(`min_count`, `min_ratio` x words) occurrences; of equal counts the first in `stoplists` wins.
    Words stay in their row and are looked up in a hash set, so neither texts nor words are shuffled.
    """
    return texts.withColumn(output, language_of(F.col(text), stoplists, min_ratio, min_count))


def language_of(
    text: Column,
    stoplists: Stoplists,
    min_ratio: float = MIN_STOPWORD_RATIO,
    min_count: int = MIN_STOPWORD_COUNT,
) -> Column:
    """The expression of `with_language`."""
    if not stoplists:
        return F.lit(None).cast("string")
    everything = sorted({word for words in stoplists.values() for word in words})

    def counts(found: Column) -> Column:
        return F.array(
            *(
                F.struct(
                    count_listed(found, listed).alias("n"),
                    F.lit(-position).alias("position"),
                    F.lit(lang).alias("lang"),
                )
                for position, (lang, listed) in enumerate(stoplists.items())
            )
        )

    def chosen(words: Column) -> Column:
        least = F.greatest(F.lit(float(min_count)), F.size(words) * F.lit(min_ratio))
        guesses = let(keep_listed(words, everything), counts)
        usable = F.filter(guesses, lambda guess: (guess["n"] > 0) & (guess["n"] >= least))
        return F.array_max(usable)["lang"]

    return let(normalised_words(text), chosen)


def corpus_words(
    corpus: DataFrame,
    text: Column,
    lang: Column,
    ignored: dict[str, list[str]] = STOPLIST_IGNORED,
    strip_chars: str = STOPLIST_STRIP_CHARS,
) -> DataFrame:
    """Words of a corpus as rows (lang, word): stripped of `strip_chars`, in lower case, without ignored ones."""
    # one pass: from the first to the last character that is not stripped, in every run without whitespace
    kept = "[^" + SPACE[1:-1] + "".join("\\" + c if c.isascii() and not c.isalnum() else c for c in strip_chars) + "]"
    found = F.regexp_extract_all(text, F.lit(f"{kept}(?:{NOT_SPACE}*{kept})?"), F.lit(0))
    words = corpus.select(lang.alias("lang"), F.explode_outer(found).alias("raw")).filter("raw IS NOT NULL")
    words = words.select("lang", F.lower("raw").alias("word"))
    for name, listed in ignored.items():
        words = words.filter((F.col("lang") != name) | ~F.col("word").isin(listed) | F.col("lang").isNull())
    return words


def word_counts(words: DataFrame) -> DataFrame:
    """Occurrences per language and word; each task counts its own words before anything is shuffled."""
    return words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))


def top_words(counts: DataFrame, n: int = STOPLIST_SIZE) -> DataFrame:
    """The `n` most frequent words per language with their rank; equal counts in word order."""
    return top_n_per_group(counts, ["lang"], [F.col("n").desc(), F.col("word").asc()], n, spread=["word"])


def coverage(counts: DataFrame, n: int = STOPLIST_SIZE) -> DataFrame:
    """Share of a corpus that its `n` most frequent words make up, in percent, per language."""
    top = top_words(counts, n).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_stopwords"), F.sum("n").alias("n_occurrences")
    )
    total = counts.groupBy("lang").agg(F.sum("n").alias("n_words"))
    return top.join(total, "lang").select(
        "lang",
        "n_stopwords",
        "n_occurrences",
        "n_words",
        (F.col("n_occurrences") * 100.0 / F.col("n_words")).alias("coverage"),
    )


def write_stoplists(ranked: DataFrame, path: str) -> None:
    """Write `word<TAB>count` lines, most frequent first, in one folder per language (at most `n` lines each)."""
    lines = ranked.select("lang", "rank", F.concat_ws("\t", "word", F.col("n").cast("string")).alias("value"))
    lines.repartition("lang").sortWithinPartitions("lang", "rank").select("lang", "value").write.partitionBy(
        "lang"
    ).mode("overwrite").text(path)
