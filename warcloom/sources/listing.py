"""Files: path globs, ID lists, stoplists, corpora and configuration tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warcloom.functions.texts import strip_space


def files(spark: SparkSession, glob: str) -> DataFrame:
    """Files of a path pattern on any file system Spark reads: path and length. No content is read."""
    return spark.read.format("binaryFile").load(glob).select("path", "length")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """Record IDs from text files, one per line: trimmed, empty lines dropped, distinct."""
    return distinct_ids(spark.read.text(path))


def distinct_ids(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(strip_space(F.col(column)).alias("id")).filter("id != ''").distinct()


def corpus(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """Lines of a text corpus of one language; compressed files are read as they are."""
    return spark.read.text(path).select(F.lit(lang).alias("lang"), F.col("value").alias("text"))


def stoplists(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Stoplists `{language: path}` as rows (lang, word): first token of each line, in lower case."""
    loaded = None
    for lang, path in paths.items():
        part = stoplist_words(spark.read.text(path).select(F.lit(lang).alias("lang"), "value"))
        loaded = part if loaded is None else loaded.unionByName(part)
    if loaded is None:
        raise ValueError("no stoplist given")
    return loaded


def stoplist_words(lines: DataFrame) -> DataFrame:
    """Words of stoplist lines (lang, value), distinct."""
    first = F.lower(F.regexp_extract(strip_space(F.col("value")), r"^[^\t-\r\x1c-\x20\x85\p{Z}]+", 0))
    return lines.select("lang", first.alias("word")).filter("word != ''").distinct()


def config_rows(spark: SparkSession, path: str) -> DataFrame:
    """Configuration files `{row: {column: value}}` as rows (row, col, value).

    A value that is no string stays JSON text. Files are read in parallel, each as one document.
    """
    return config_cells(spark.read.text(path, wholetext=True).select(F.col("value").alias("document")))


def config_cells(documents: DataFrame) -> DataFrame:
    rows = F.from_json("document", "map<string,map<string,string>>")
    return (
        documents.select(F.explode(rows).alias("row", "cells"))
        .select("row", F.explode("cells").alias("col", "value"))
        .select("row", "col", "value")
    )
