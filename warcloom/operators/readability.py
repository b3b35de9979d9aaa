"""Sentence, word and syllable counts, and the reading ease they give."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.functions import tokens as tk


def with_tokens(texts: DataFrame, text: str = "plain_text", output: str = "plain_text_tokens") -> DataFrame:
    return texts.withColumn(output, tk.tokens(F.col(text)))


def with_sentences(
    texts: DataFrame, text: str = "plain_text", language: str = "language", output: str = "plain_text_sentences"
) -> DataFrame:
    return texts.withColumn(output, tk.sentences(F.col(text), F.col(language)))


def with_reading_ease(texts: DataFrame, text: str = "plain_text", language: str = "language") -> DataFrame:
    """Add n_sentences, n_words, n_syllables and reading_ease; no text gives 0, 0, 0 and null.

    Counts come from the text of the row alone, so this adds no shuffle. Tokens or sentences that are there already
    are used.
    """
    made = [F.col(name) if name in texts.columns else None for name in ("plain_text_tokens", "plain_text_sentences")]
    statistics = texts.withColumn("_statistics", tk.text_statistics(F.col(text), F.col(language), *made))
    names = ["n_sentences", "n_words", "n_syllables", "reading_ease"]
    return statistics.withColumns({name: F.col(f"_statistics.{name}") for name in names}).drop("_statistics")
