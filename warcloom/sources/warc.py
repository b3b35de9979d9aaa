"""WARC collections as DataFrames.

Python only frames records: it finds gzip members, header blocks and payload bytes, and undoes transfer and content
encodings. Headers become maps and fields in Catalyst (`operators.records`).
"""

from __future__ import annotations

import hashlib
import logging
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from warcloom.fixed_values import MAX_RECORD_BYTES, RECORD_TYPES
from warcloom.session import stored
from warcloom.sources.listing import files

SCHEMA = (
    "warc_filename string, warc_offset long, rec_block string, http_block string, content binary, scan_error string"
)
_ARROW_SCHEMA = pa.schema(
    [
        ("warc_filename", pa.string()),
        ("warc_offset", pa.int64()),
        ("rec_block", pa.string()),
        ("http_block", pa.string()),
        ("content", pa.binary()),
        ("scan_error", pa.string()),
    ]
)
# How `scan_error` ends for a payload whose encoding is known but has no decoder here.
NOT_DECODED = "is not decoded"
_CHUNK = 1 << 20
_BATCH_BYTES = 32 << 20
_BATCH_ROWS = 1000
_RECORD_LINE = re.compile(rb"\nWARC/[0-9.]{1,8}\r?\n")
_HTTP_TYPES = ("response", "revisit", "request")
FILE_END = 2**62
# Whether a record, by its offset, header block and header fields, has its payload built.
Keep = Callable[[int, str, dict[str, str]], bool]


def scan(
    spark: SparkSession,
    glob: str,
    record_types: Iterable[str] = RECORD_TYPES,
    max_record_bytes: int = MAX_RECORD_BYTES,
    split_bytes: int = 512 << 20,
    all_records: bool = False,
) -> DataFrame:
    """One row per record of the wanted types and sizes.

    Type and size are checked while framing, so unwanted payloads are never kept; with `all_records` such a record gives
    a row without payload, so that gates can count it. A file larger than `split_bytes` is read by several tasks: in a
    gzip file each starts at the first member of its range that holds a record, in a plain file where `plain_ranges`
    found that the records of the range begin. An unreadable file, or a corrupt record, gives one row with `scan_error`
    and no headers; reading goes on at the next gzip member, or line, that begins a record, so the rows are the same for
    every `split_bytes`.
    """
    return scan_files(files(spark, glob), record_types, max_record_bytes, split_bytes, all_records)


def scan_files(
    listed: DataFrame,
    record_types: Iterable[str] = RECORD_TYPES,
    max_record_bytes: int = MAX_RECORD_BYTES,
    split_bytes: int = 512 << 20,
    all_records: bool = False,
) -> DataFrame:
    """`scan` over files given as rows (path, length)."""
    ranges = _ranges(listed, split_bytes)
    tasks = max(ranges.count(), 1)  # the listing is metadata only; one task per range
    keep = keep_of(record_types, max_record_bytes)

    def frame(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from in_batches(frame_range(row["path"], row["start"], row["end"], keep, all_records))

    return ranges.repartitionByRange(tasks, "path", "start").mapInArrow(frame, SCHEMA)


def keep_of(record_types: Iterable[str], max_record_bytes: int) -> Keep:
    wanted = frozenset(record_types)
    return lambda offset, rec_block, fields: fields.get("warc-type") in wanted and int(fields["content-length"]) <= max_record_bytes


def _ranges(listed: DataFrame, split_bytes: int) -> DataFrame:
    """Ranges (path, start, end) of files (path, length); a range has the records that begin in it."""
    compressed = F.col("path").endswith(".gz")
    large = listed.filter(~compressed & (F.col("length") > split_bytes))
    last = F.when(compressed, F.greatest(F.col("length") - 1, F.lit(0))).otherwise(F.lit(0)).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), last, F.lit(split_bytes).cast("long"))
    ranges = (
        listed.filter(compressed | (F.col("length") <= split_bytes))
        .select("path", last.alias("last"), F.explode(starts).alias("start"))
        .select("path", "start", F.when(F.col("last") > 0, F.col("start") + split_bytes).otherwise(F.lit(FILE_END)).alias("end"))
    )
    return ranges if large.isEmpty() else ranges.unionByName(plain_ranges(large, split_bytes))


def plain_ranges(listed: DataFrame, split_bytes: int) -> DataFrame:
    """Ranges (path, start, end) of plain files (path, length), each starting at the first of its records.

    Nothing in a plain file tells a record from one that lies in the payload of another, an archive within an archive.
    So every range is walked from a guess, in parallel and without building payloads, to the first record behind it. A
    range begins where the records of all before it end; one that was walked from elsewhere is walked again. The first
    begins at 0, so once no range is wrong all are right, and each turn mends at least one more range of a file. One
    turn does unless a payload holds records at the start of a range. Only ranges, no records, are shuffled.
    """
    starts = F.sequence(F.lit(0).cast("long"), (F.col("length") - 1).cast("long"), F.lit(split_bytes).cast("long"))
    ranges = listed.select("path", F.explode(starts).alias("start")).select(
        "path", "start", (F.col("start") + split_bytes).alias("end"), F.when(F.col("start") == 0, F.lit(0).cast("long")).alias("entry")
    )
    walked = stored(_walked(ranges), "ranges")
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        seen = walked.withColumn("begin", F.coalesce(F.max("exit").over(before), F.lit(0).cast("long")))
        wrong = seen.filter("begin != entry").select("path", "start", "end", F.col("begin").alias("entry"))
        if wrong.isEmpty():
            # what reaches the end of the file is read to it, in whatever form the bytes are
            end = F.when(F.col("exit") == FILE_END, F.col("exit")).otherwise(F.col("end"))
            return walked.filter("entry < end").select("path", F.col("entry").alias("start"), end.alias("end"))
        walked = stored(seen.filter("begin = entry").drop("begin").unionByName(_walked(wrong)), "ranges")


def _walked(ranges: DataFrame) -> DataFrame:
    """Ranges (path, start, end, entry) with the offset of the first record behind them as `exit`; `entry` may be null."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row | dict(zip(("entry", "exit"), _walk_range(**row), strict=True)) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=_WALKED)

    tasks = max(ranges.count(), 1)
    return ranges.repartitionByRange(tasks, "path", "start").mapInArrow(
        walk, "path string, start long, end long, entry long, exit long"
    )


_WALKED = pa.schema([("path", pa.string())] + [(name, pa.int64()) for name in ("start", "end", "entry", "exit")])


def _walk_range(path: str, start: int, end: int, entry: int | None) -> tuple[int, int]:
    if entry is not None and entry >= end:
        return entry, entry
    try:
        with _open(path) as raw:
            if entry is None:
                entry = _likely_record(raw, start, end)
                if entry >= end:
                    return entry, entry
            stream = _RecordStream(raw, entry, end)
            if not stream.gzip:
                for _ in _records(stream, lambda offset, rec_block, fields: False):
                    pass
                if stream.buffer:
                    return entry, stream.offset
    except OSError:  # the scan reports it
        entry = start if entry is None else entry
    return entry, FILE_END


def _likely_record(raw, start: int, end: int) -> int:
    """Offset in a plain file of the first line from `start` on that begins a record which another one, or the end of the
    file, follows; `end` if there is none before."""
    base = max(start - 1, 0)
    while base < end:
        raw.seek(base)
        window = raw.read(_CHUNK)
        for match in _RECORD_LINE.finditer(window):
            at = base + match.start() + 1
            if at >= end:
                return end
            raw.seek(at)
            head, mark, _ = raw.read(1 << 16).partition(b"\r\n\r\n")
            length = header_fields(_text(head)).get("content-length", "") if mark else ""
            if length.isdigit():
                raw.seek(min(at + len(head) + len(mark) + int(length), raw.size()))
                if raw.read(32).lstrip(b"\r\n")[:5] in (b"WARC/", b""):
                    return at
        if len(window) <= 16:
            return end
        base += len(window) - 16
    return end


def in_batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    pending, size = [], 0
    for row in rows:
        pending.append(row)
        size += len(row["content"] or b"")
        if size >= _BATCH_BYTES or len(pending) >= _BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(pending, schema=_ARROW_SCHEMA)
            pending, size = [], 0
    if pending:
        yield pa.RecordBatch.from_pylist(pending, schema=_ARROW_SCHEMA)


def frame_range(path: str, start: int, end: int, keep: Keep, all_records: bool) -> Iterator[dict]:
    row = dict.fromkeys(_ARROW_SCHEMA.names) | {"warc_filename": path}
    try:
        with _open(path) as raw:
            stream = _RecordStream(raw, start, end)
            if not stream.gzip and path.endswith(".gz"):  # ranges of this file are meant for members
                stream.end, stream.none_here = FILE_END, start > 0
            for record in _records(stream, keep):
                if all_records or record.get("content") is not None or record.get("rec_block") is None:
                    yield row | record
    except Exception as problem:  # a broken file must not fail the job
        logging.getLogger(__name__).error("%s: %s", path, problem)
        yield row | {"scan_error": f"{type(problem).__name__}: {problem}"}


def _records(stream: _RecordStream, keep: Keep) -> Iterator[dict]:
    """Records of a stream, with what could not be read as rows of `scan_error` alone."""
    while True:
        try:
            if (offset := stream.next_record()) is None:
                return
            record = _frame_record(stream, offset, keep)
        except (ValueError, EOFError, zlib.error) as problem:  # a broken record must not hide those after it
            yield {"warc_offset": stream.offset, "scan_error": f"{type(problem).__name__}: {problem}"}
            if not stream.resume():
                return
        else:
            yield {"warc_offset": offset} | record


def fetch_records(path: str, wanted: set[tuple[int, str]], keep: Keep) -> Iterator[dict]:
    """Records of one file by (offset, MD5 of the header block). Only payloads of these that `keep` takes are built.

    Reading starts at each offset. What does not begin there, as after a damaged gzip member, is found by reading the file
    from its start; what is not found at all is a row with `scan_error`.
    """
    row = dict.fromkeys(_ARROW_SCHEMA.names) | {"warc_filename": path}
    left = set(wanted)

    def among(stream: _RecordStream, sought: set[tuple[int, str]]) -> Iterator[dict]:
        def chosen(offset: int, rec_block: str, fields: dict[str, str]) -> bool:
            return (offset, _digest(rec_block)) in sought and keep(offset, rec_block, fields)

        for record in _records(stream, chosen):
            if record.get("rec_block") is not None and (key := (record["warc_offset"], _digest(record["rec_block"]))) in sought:
                left.discard(key)
                yield row | record

    try:
        with _open(path) as raw:
            for offset in sorted({offset for offset, _ in wanted}):
                yield from among(_RecordStream(raw, offset, offset + 1), {key for key in wanted if key[0] == offset})
            if left:
                yield from among(_RecordStream(raw, 0, FILE_END), frozenset(left))
        lost = "record is gone"
    except Exception as problem:  # a broken file must not fail the job
        logging.getLogger(__name__).error("%s: %s", path, problem)
        lost = f"{type(problem).__name__}: {problem}"
    for offset, _ in sorted(left):
        yield row | {"warc_offset": offset, "scan_error": lost}


def _digest(rec_block: str) -> str:
    return hashlib.md5(rec_block.encode(), usedforsecurity=False).hexdigest()


def _file_system(path: str):
    """File system of a path, and the path within it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _open(path: str):
    system, inner = _file_system(path)
    return system.open_input_file(inner)


def list_files(pattern: str) -> Iterator[tuple[str, int]]:
    """(path, length) of a file, of the files in a folder, or of those that a pattern with `*` and `?` names, in order.

    The way without a session, for a data source; `listing.files` is the one of a session.
    """
    from pyarrow import fs

    at = next((at for at, sign in enumerate(pattern) if sign in "*?"), None)
    known = pattern if at is None else pattern[:at].rpartition("/")[0]
    system, root = _file_system(known if "://" in known or known.startswith("file:") else f"file:{known}")
    scheme = "file:" if isinstance(system, fs.LocalFileSystem) else known[: known.index(root)] if root else known
    info = system.get_file_info(root)
    if info.type == fs.FileType.File:
        found = [info]
    else:
        found = system.get_file_info(fs.FileSelector(root, recursive=at is not None))
    wild = None
    if at is not None:
        rest = pattern[len(known) :].lstrip("/")
        shape = "".join({"*": "[^/]*", "?": "[^/]"}.get(sign, re.escape(sign)) for sign in rest)
        wild = re.compile(shape)
    for one in sorted(found, key=lambda one: one.path):
        if one.type == fs.FileType.File and (wild is None or wild.fullmatch(one.path[len(root) :].lstrip("/"))):
            if not one.base_name.startswith(("_", ".")):
                yield scheme + one.path, one.size


class _RecordStream:
    """Bytes of a plain or gzip file from a record start on; knows the file offset of that start."""

    def __init__(self, raw, start: int, end: int):
        self.raw, self.end = raw, end
        self.buffer = b""
        self.engine = None
        raw.seek(0)
        self.gzip = raw.read(2) == b"\x1f\x8b"
        self.none_here = False
        if start > 0 and self.gzip:
            start = self._first_member(start)
            self.none_here = start >= end
        raw.seek(start)
        self.position = start  # of the next raw byte that was not used yet
        self.raw_buffer = b""
        self.offset = start

    def _first_member(self, start: int) -> int:
        """Offset of the first gzip member at or after `start` that begins with a record."""
        self.raw.seek(start)
        base, window = start, self.raw.read(_CHUNK)
        while window and base < self.end:
            at = window.find(b"\x1f\x8b\x08")
            while at >= 0:
                if _begins_with_record(window[at : at + 4096]) or (
                    len(window) - at < 4096 and _begins_with_record(self._peek(base + at, 4096))
                ):
                    return base + at
                at = window.find(b"\x1f\x8b\x08", at + 1)
            keep = window[-2:] if len(window) > 2 else b""
            base += len(window) - len(keep)
            self.raw.seek(base + len(keep))
            more = self.raw.read(_CHUNK)
            window = keep + more if more else b""
        return self.end

    def resume(self) -> bool:
        """Go on behind a broken record: at the next line that begins one, in a gzip file within this member's bytes or
        at the next member that begins one. False if there is none."""
        while True:
            if match := _RECORD_LINE.search(self.buffer):
                self._used(match.start() + 1)
                return True
            if self.gzip:
                break
            self._used(max(len(self.buffer) - 16, 0))
            if not self._more():
                return False
        start = self._first_member(self.offset + 1)
        if start >= self.end:
            return False
        self.raw.seek(start)
        self.position = self.offset = start
        self.buffer, self.raw_buffer, self.engine = b"", b"", None
        return True

    def _peek(self, at: int, size: int) -> bytes:
        self.raw.seek(at)
        return self.raw.read(size)

    def _more(self) -> bool:
        """Get more bytes into the buffer. In a gzip file this never goes past the end of a member."""
        if not self.gzip:
            chunk = self.raw.read(_CHUNK)
            self.buffer += chunk
            return bool(chunk)
        while True:
            if not self.raw_buffer:
                self.raw_buffer = self.raw.read(_CHUNK)
                if not self.raw_buffer:
                    if self.engine is not None:
                        raise EOFError("gzip member is cut off")
                    return False
            if self.engine is None:
                self.engine = zlib.decompressobj(31)
                if not self.buffer:
                    self.offset = self.position
            data = self.engine.decompress(self.raw_buffer, _CHUNK)
            rest = self.engine.unused_data if self.engine.eof else self.engine.unconsumed_tail
            self.position += len(self.raw_buffer) - len(rest)
            self.raw_buffer = rest
            if self.engine.eof:
                self.engine = None
            self.buffer += data
            if data:
                return True

    def next_record(self) -> int | None:
        """Go to the next record and return its offset; None at the end of file or range."""
        if self.none_here:
            return None
        while True:
            stripped = self.buffer.lstrip(b"\r\n")
            self._used(len(self.buffer) - len(stripped))
            if len(self.buffer) >= 5 or not self._more():
                break
        if not self.buffer:
            return None
        # in a gzip file the next range begins at the first member that holds a record; what lies before it belongs here
        behind = self.offset >= self.end and (not self.gzip or self.buffer.startswith(b"WARC/"))
        return None if behind else self.offset

    def _used(self, size: int) -> None:
        self.buffer = self.buffer[size:]
        if not self.gzip:
            self.offset += size

    def block(self) -> bytes:
        """Header block up to its blank line, which is used up too."""
        searched = 0
        while True:
            for mark in (b"\r\n\r\n", b"\n\n"):
                at = self.buffer.find(mark, max(searched - 3, 0))
                if at >= 0:
                    block = self.buffer[:at]
                    self._used(at + len(mark))
                    return block
            searched = len(self.buffer)
            if not self._more():
                raise ValueError("record header without end")

    def take(self, size: int, keep: bool) -> bytes:
        parts = []
        if not keep and not self.gzip and size > len(self.buffer) + _CHUNK and self.offset + size <= self.raw.size():
            self.offset += size
            self.raw.seek(self.offset)
            self.buffer, size = b"", 0
        while size > 0:
            if not self.buffer and not self._more():
                raise EOFError("record is cut off")
            part = self.buffer[:size]
            self._used(len(part))
            size -= len(part)
            if keep:
                parts.append(part)
        return b"".join(parts)


def _begins_with_record(member: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(member, 5) == b"WARC/"
    except zlib.error:
        return False


def header_fields(block: str) -> dict[str, str]:
    """Header lines by lower-case name, for framing only."""
    pairs = (line.partition(":") for line in block.splitlines()[1:])
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def _text(block: bytes) -> str:
    try:
        return block.decode("utf-8")
    except UnicodeDecodeError:
        return block.decode("iso-8859-1")


def _frame_record(stream: _RecordStream, offset: int, keep: Keep) -> dict:
    """A record; `content` is null if its payload is not kept."""
    if not stream.buffer.startswith(b"WARC/"):  # nothing is used up: a record may begin at one of the next lines
        raise ValueError("not a WARC record")
    rec_block = _text(stream.block())
    fields = header_fields(rec_block)
    kind, length = fields.get("warc-type"), fields.get("content-length", "")
    if not length.isdigit():
        raise ValueError("record without length")
    kept = keep(offset, rec_block, fields)
    body = stream.take(int(length), kept)
    http_block, error = None, None
    if not kept:
        body = None
    elif kind in _HTTP_TYPES and fields.get("warc-target-uri", "").lower().startswith(("http:", "https:")) and body:
        head, mark, rest = body.partition(b"\r\n\r\n")
        if not mark:
            head, mark, rest = body.partition(b"\n\n")
        if head.startswith(b"HTTP/"):
            http_block = _text(head)
            body, error = _decoded(rest, header_fields(http_block))
    return {"rec_block": rec_block, "http_block": http_block, "content": body, "scan_error": error}


def _decoded(body: bytes, fields: dict[str, str]) -> tuple[bytes, str | None]:
    """Payload without transfer and content encodings, the last one undone first; as it came, with a reason, where that fails.

    Names that are no encodings are passed over.
    """
    names = ",".join([fields.get("content-encoding", ""), fields.get("transfer-encoding", "")]).lower().split(",")
    data = body
    for encoding in reversed([name.strip() for name in names]):
        if not data:
            break
        if encoding == "chunked":
            data, error = _without_chunks(data)
        elif encoding == "br":
            data, error = _without_brotli(data)
        elif encoding in _WINDOW_BITS:
            data, error = _inflated(data, encoding)
        else:
            error = f"content-encoding {encoding} {NOT_DECODED}" if encoding in ("compress", "x-compress", "zstd") else None
        if error:
            return body, error
    return data, None


_WINDOW_BITS = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}


def _inflated(body: bytes, encoding: str) -> tuple[bytes, str | None]:
    """All members of a compressed payload; what follows the last one and is no member is left out."""
    for bits in _WINDOW_BITS[encoding]:
        parts, rest = [], body
        try:
            while rest:
                engine = zlib.decompressobj(bits)
                parts.append(engine.decompress(rest))
                if not engine.eof:
                    return body, f"content-encoding {encoding} is cut off"
                rest = engine.unused_data if engine.unused_data.startswith(b"\x1f\x8b") else b""
        except zlib.error:
            continue
        return b"".join(parts), None
    return body, f"content-encoding {encoding} is broken"


def _without_brotli(body: bytes) -> tuple[bytes, str | None]:
    try:
        import brotli  # optional: not part of the standard library
    except ImportError:
        return body, f"content-encoding br {NOT_DECODED}"
    try:
        return brotli.decompress(body), None
    except brotli.error:
        return body, "content-encoding br is broken"


def _without_chunks(body: bytes) -> tuple[bytes, str | None]:
    """Chunks put together. A body that begins with no chunk size was not chunked; one that breaks off later is an error."""
    parts, at = [], 0
    while True:
        line_end = body.find(b"\r\n", at)
        size = _CHUNK_SIZE.fullmatch(body, at, line_end) if line_end >= 0 else None
        if size is None:
            return (body, f"transfer-encoding chunked: broken size line, {NOT_DECODED}") if parts else (body, None)
        length = int(size[1], 16)
        if length == 0:
            return b"".join(parts), None
        at = line_end + 2 + length
        if at > len(body):
            return body, f"transfer-encoding chunked: cut off, {NOT_DECODED}"
        parts.append(body[line_end + 2 : at])
        at += 2
        if at >= len(body):
            return b"".join(parts), None


_CHUNK_SIZE = re.compile(rb"[ \t]*([0-9a-fA-F]{1,16})[ \t]*(?:;[^\r\n]*)?")
