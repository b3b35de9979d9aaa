"""Documents to packed training sequences.

STAGES are applied in order; each one's rows are written as Parquet and read again as the documents of the next. All but the
last return the columns of documents: language identification drops documents without a known language, near-duplicate
classes keep one document each, documents with benchmark passages go, secrets are replaced by a mark, and what is left is
packed into sequences. Extra columns stay as they are, whatever their names; an empty table gives empty tables throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from warcloom.llm.op02_weighted_minhash import keep_one
from warcloom.llm.op05_secrets import redact_secrets
from warcloom.llm.op06_language import keep_known
from warcloom.llm.op07_packing import pack_documents
from warcloom.llm.op10_latent_leaks import without_leaks
from warcloom.llm.stored import stored


#: Score of a language that counts as found; scores are probabilities after calibration.
LEAST = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found: one that is at least as likely as all others together. Null and empty texts and
    those without a letter go; if no row has a text and a label, nothing is learned and all go. Each row is judged by itself,
    repeated rows alike."""
    return keep_known(docs, LEAST)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the smallest doc_id, of rows that share it the first by text. Null,
    empty and blank texts are alone in their classes and stay, as do all rows without doc_id."""
    return keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Each row is judged by its own text; null and empty texts stay. Items
    without a word, or an empty benchmark, reject nothing."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark. Null texts stay null; no row goes."""
    return redact_secrets(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which sequence. A null or empty text is one piece of its end id; rows that
    share a doc_id are packed each for itself."""
    return pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("secrets", mark_secrets),
    ("packing", pack_sequences),
]

#: SQL has no form for the trained and compressed decisions; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for _, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir))
    return STAGES[-1][1](spark, rows, sf_dir)
