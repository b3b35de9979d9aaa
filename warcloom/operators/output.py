"""Rows that are stored: keys, columns, the rest as JSON, cells, and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.fixed_values import DROPPED_FIELDS, SEPARATE_COLUMNS

# Columns of our own that the stored JSON does not contain.
WORK_COLUMNS = ["is_revisit", "mime_group", "warc_type", "scan_error", "errors"]


def row_key(record_id: Column) -> Column:
    return F.regexp_replace(record_id, "^urn:uuid:", "")


def export_name(column: str) -> str:
    """Field name of the exported format."""
    return column.replace("_", "-")


def as_text(records: DataFrame, column: str) -> Column:
    """A column as the text of a cell: strings as they are, nested values as JSON."""
    kind = records.schema[column].dataType.typeName()
    return F.col(column) if kind == "string" else F.to_json(column) if kind in ("array", "map", "struct") else (
        F.col(column).cast("string")
    )


def decompose(records: DataFrame, separate: list[str] = SEPARATE_COLUMNS, dropped: list[str] = DROPPED_FIELDS):
    """Key, one text column per separate field (empty if missing), and `IF` with all other fields as JSON.

    Fields that are null are absent from the JSON.
    """
    columns = [
        F.coalesce(as_text(records, name), F.lit("")).alias(name)
        if name in records.columns
        else F.lit("").alias(name)
        for name in separate
    ]
    left_out = set(separate) | set(dropped) | set(WORK_COLUMNS)
    rest = [F.col(name).alias(export_name(name)) for name in records.columns if name not in left_out]
    return records.select(row_key(F.col("id")).alias("key"), *columns, F.to_json(F.struct(*rest)).alias("IF"))


def extra_rows(records: DataFrame) -> DataFrame:
    """Key and readability of every record; only the key if no step has computed it."""
    extra = ["url", "n_sentences", "n_words", "n_syllables", "reading_ease"]
    found = extra if "reading_ease" in records.columns else []
    return records.select(row_key(F.col("id")).alias("key"), *found)


def write_text(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON line per row."""
    rows.write.mode(mode).json(path)


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).option("header", True).csv(path)


def write_table(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with keys sorted within each file and a Bloom filter over them.

    Rows stay in their partitions, so a large table is written without a shuffle; a point read skips every row group
    whose filter or range excludes the key.
    """
    sorted_rows = rows.sortWithinPartitions("key")
    sorted_rows.write.mode(mode).option("parquet.bloom.filter.enabled#key", "true").parquet(path)


def upsert(stored: DataFrame, batch: DataFrame, key: str = "key", version: str | None = None) -> DataFrame:
    """Stored rows after a batch of puts: cells of the batch replace stored ones, null cells leave them.

    With `version`, a key may occur more than once in the batch, and its newest cell counts. One shuffle by key; rows
    are combined in every task before it, so no key can be hot.
    """
    cells = [name for name in stored.columns if name != key]
    order = F.col(version).cast("long") if version else F.lit(1).cast("long")
    old = stored.select(key, *cells, F.lit(None).cast("long").alias("_version"))
    new = batch.select(
        key, *(F.col(name) if name in batch.columns else F.lit(None).alias(name) for name in cells), order.alias("_version")
    )
    both = old.unionByName(new)
    # stored rows rank below every batch row
    rank = F.struct(F.col("_version").isNotNull().alias("new"), F.coalesce("_version", F.lit(0)).alias("version"))
    newest = [
        F.max_by(F.col(name), F.when(F.col(name).isNotNull(), rank)).alias(name) for name in cells
    ]
    return both.groupBy(key).agg(*newest)


def cells(rows: DataFrame, key: str = "key") -> DataFrame:
    """Long form (row, column, value): strings as they are, other values as JSON; null cells are left out."""
    columns = [name for name in rows.columns if name != key]
    texts = rows.select(F.col(key).alias("row"), *(as_text(rows, name).alias(name) for name in columns))
    return texts.unpivot(["row"], columns, "column", "value").filter("value IS NOT NULL")
