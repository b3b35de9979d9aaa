"""WARC collections as a Spark data source: `spark.read.format("warc").load(glob)` after `register(spark)`.

Filters on file, type, size and ID are applied while framing, so payloads of other records are never built; a file that a
filter rules out is not opened. A schema names the columns wanted: `.schema("warc_record_id string, warc_type string")`.
Without `content` and `http_block` among them no payload is built at all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from warcloom.sources.warc import FILE_END, frame_range, header_fields, list_files

COLUMNS = {
    "warc_filename": pa.string(),
    "warc_offset": pa.int64(),
    "warc_type": pa.string(),
    "warc_record_id": pa.string(),
    "warc_record_size": pa.int64(),
    "rec_block": pa.string(),
    "http_block": pa.string(),
    "content": pa.binary(),
    "scan_error": pa.string(),
}
_SPARK_TYPES = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary"}
SCHEMA = ", ".join(f"{name} {_SPARK_TYPES[kind]}" for name, kind in COLUMNS.items())
_BATCH_BYTES = 32 << 20
_BATCH_ROWS = 1000


def register(spark: SparkSession) -> SparkSession:
    """Make the format known to a session, and let it have filters."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


@dataclass
class FileRange(InputPartition):
    path: str
    start: int
    end: int


class WarcSource(DataSource):
    """Options: `path`, a file, a folder or a pattern with `*` and `?`; `splitBytes` for files of gzip members."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        unknown = [name for name in schema.names if name not in COLUMNS]
        if unknown:
            raise ValueError(f"the WARC source has no column {unknown[0]!r}; it has {', '.join(COLUMNS)}")
        return WarcReader(schema.names, self.options["path"], int(self.options.get("splitBytes", 512 << 20)))


class WarcReader(DataSourceReader):
    def __init__(self, names: list[str], path: str, split_bytes: int):
        self.names, self.path, self.split_bytes = names, path, split_bytes
        self.allowed: dict[str, set[str]] = {}  # values a column may have
        self.most: int | None = None  # bytes of a record

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for each in filters:
            column = each.attribute[0]
            if isinstance(each, (EqualTo, In)) and column in ("warc_filename", "warc_type", "warc_record_id"):
                values = {each.value} if isinstance(each, EqualTo) else set(each.value)
                self.allowed[column] = self.allowed.get(column, values) & values
            elif isinstance(each, (LessThan, LessThanOrEqual)) and column == "warc_record_size":
                most = each.value - isinstance(each, LessThan)
                self.most = most if self.most is None else min(self.most, most)
            else:
                yield each

    def partitions(self) -> list[FileRange]:
        """Ranges of gzip files and whole plain files: metadata of the listing only."""
        found = []
        for path, length in list_files(self.path):
            if path not in self.allowed.get("warc_filename", (path,)):
                continue
            if not path.endswith(".gz") or length <= self.split_bytes:
                found.append(FileRange(path, 0, FILE_END))
            else:
                starts = range(0, length, self.split_bytes)
                found += [FileRange(path, start, start + self.split_bytes) for start in starts]
        return found or [FileRange("", 0, 0)]

    def _passes(self, row: dict) -> bool:
        if any(row[column] not in values for column, values in self.allowed.items()):
            return False
        return self.most is None or (row["warc_record_size"] is not None and row["warc_record_size"] <= self.most)

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(name, COLUMNS[name]) for name in self.names])
        payload = not {"content", "http_block"}.isdisjoint(self.names)

        def keep(offset: int, rec_block: str, fields: dict[str, str]) -> bool:
            return payload and self._passes(_described({"warc_filename": partition.path}, fields))

        pending, size = [], 0
        for record in frame_range(partition.path, partition.start, partition.end, keep, True) if partition.path else ():
            row = _described(record, header_fields(record["rec_block"] or ""))
            if not self._passes(row):
                continue
            pending.append({name: row[name] for name in self.names})
            size += len(row["content"] or b"")
            if size >= _BATCH_BYTES or len(pending) >= _BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(pending, schema=schema)
                pending, size = [], 0
        if pending:
            yield pa.RecordBatch.from_pylist(pending, schema=schema)


def _described(record: dict, fields: dict[str, str]) -> dict:
    """A framed record with what its header tells; null where the header does not."""
    size = fields.get("content-length", "")
    return record | {
        "warc_type": fields.get("warc-type"),
        "warc_record_id": re.sub("^<+|>+$", "", fields["warc-record-id"]) if "warc-record-id" in fields else None,
        "warc_record_size": int(size) if size.isdigit() else None,
    }
