"""Secret scan: fixed patterns, and novelty measured by a dictionary-primed compressor.

Base kinds are patterns: ``assign`` (a name such as token or api_key, a sign, a value of 12 or more characters), ``access``
(AKIA and capitals, 18 or more) and ``hex`` (16 or more). The method adds ``novel``: a run of at least 20 letters, digits
and ``+/_=-`` that follows a sensitive word within 40 characters. Zstandard is primed with a dictionary of common
identifiers and with the text around the run; the run is reported if it adds at least ``NOVEL`` bytes per character to the
compressed context. Words, paths and repeated identifiers add little, keys add nearly all their bytes.

A span is (kind, start, end) in code points, end exclusive; a novel span that overlaps a base span is not added. Spans are
ordered by start, then by kind in the order above.

Rules: null is an empty text and has no spans. Every row gives one row, repeated ones too; an empty table gives none.
Columns other than doc_id and text are not looked at. Matches are ASCII only, in either case for names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
NOVEL, AROUND, NEAR = 0.65, 256, 40
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"
REDACTED = "[redacted]"

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_SENSITIVE = re.compile(r"pass|pwd|secret|token|key|auth|cred|bearer|private|signature", re.ASCII | re.IGNORECASE)

IDENTIFIERS = (
    "access_token api_key apikey authorization bearer client_id client_secret config connection const credentials def",
    "environment export function header host import json key localhost name none null password path port private_key",
    "public return secret self session signature string token true url user username value var version http https",
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 example_value placeholder changeme undefined",
)


@cache
def _primed() -> zstandard.ZstdCompressor:
    words = zstandard.ZstdCompressionDict("\n".join(IDENTIFIERS).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    words.precompute_compress(level=3)
    return zstandard.ZstdCompressor(dict_data=words, write_checksum=False, write_content_size=False)


def marginal_bytes(before: str, run: str, after: str) -> int:
    """Bytes that a run adds to the compressed text around it."""
    size = lambda text: len(_primed().compress(text.encode()))
    return size(f"{before}\n{after}\n{run}") - size(f"{before}\n{after}\n")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns in order; kind as a place in KINDS."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = []
    for m in _RUN.finditer(text):
        a, z = m.span()
        if not _SENSITIVE.search(text, max(0, a - NEAR), a) or any(s < z and a < e for s, _, e in base):
            continue
        if marginal_bytes(text[max(0, a - AROUND) : a], m[0], text[z : z + AROUND]) >= NOVEL * (z - a):
            found.append((a, 3, z))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, overlapping ones together, replaced by a mark."""
    out, at = [], 0
    for a, _, z in spans:
        if a >= at:
            out += [text[at:a], REDACTED]
        at = max(at, z)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text, ..) with counts, digest and spans."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                base = base_spans(text or "")
                new = novel_spans(text or "", base)
                count = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((doc_id, *count, len(new), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + new))))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, SCHEMA)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """docs with the secrets in ``text`` replaced by a mark; rows and columns stay. Null texts stay null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            for k, text in enumerate(texts):
                if text:
                    base = base_spans(text)
                    if spans := sorted(base + novel_spans(text, base)):
                        texts[k] = redact(text, spans)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(work, docs.schema)
