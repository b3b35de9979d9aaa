"""Fill-in-middle transformation by secondary sort: pieces are shuffled once, and every text is put together as a stream.

A task cuts each text into pieces of at most ``UNIT`` code points, keyed by the document and the piece's place in the
output. One repartition by document with a sort by (document, place) within the partitions, the DataFrame form of
``repartitionAndSortWithinPartitions``, brings the pieces in output order to one task, which feeds them into a digest as
they come; no text is put together in memory. For the way back the same rows are sorted again within their partitions, by
what the output itself tells (which mark opened a stretch, and the order within it), and stream into a second digest. So
texts cross the network once, and both sorts spill.

A document is plain if its text is empty or holds a mark, or by its hash; otherwise its text is cut twice at places that the
hash gives, and the three parts are put in the order of ``psm`` or ``spm``.

A document is keyed by a 128-bit digest of id and text and by the number of the input partition. Both depend on rows only,
so a task that runs again gives the same keys. Repeated rows of one partition share a key, arrive as repeated pieces, and
are counted; those of other partitions have another key. So no key gets more rows than one input partition holds, however
often a row is repeated.

Rules: null is an empty text; a null id hashes as the empty string. Every row gives one row, repeated ones too; an empty table
gives none. Long texts are many pieces. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: Stretches of the text in their own order, by the mark that opens them.
STRETCH = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
SEED, PLAIN_FROM, SPM_BELOW = "1", 90, 20

_KEY = "mark binary, part int"
_FACTS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
_PIECE = pa.schema(
    [("mark", pa.binary()), ("part", pa.int32()), ("at", pa.int64()), ("piece", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64())]
    + [("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
)
_PIECE_SQL = f"{_KEY}, at long, piece string, {_FACTS}"
_SORTED = pa.schema([*_PIECE, ("stretch", pa.int32()), ("copies", pa.int64()), ("output_sha256", pa.string())])
_SORTED_SQL = f"{_PIECE_SQL}, stretch int, copies long, output_sha256 string"
DIGESTS = f"{_FACTS}, output_sha256 string, restored_sha256 string"
TEXTS = f"{_FACTS}, output string"


@dataclass(frozen=True)
class Plan:
    """What becomes of a text: its form, and the code points of prefix and middle (null if plain)."""

    n: int
    form: str
    prefix: int | None = None
    middle: int | None = None


def plan(doc_id: int | None, text: str, seed: str = SEED) -> Plan:
    n, h = len(text), hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= PLAIN_FROM:
        return Plan(n, "plain")
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return Plan(n, "spm" if h4 % 100 < SPM_BELOW else "psm", low, high - low)


def pieces_of(text: str, made: Plan, unit: int = UNIT) -> list[str]:
    """The output in order, as pieces of at most ``unit`` code points; a piece that opens a stretch has its mark before it."""

    def cut(low: int, high: int, mark: str = "") -> list[str]:
        return [(mark if at == low else "") + text[at : min(at + unit, high)] for at in range(low, max(high, low + 1), unit)]

    if made.form == "plain":
        return cut(0, made.n)
    a, z = made.prefix, made.prefix + made.middle
    prefix, middle, suffix = cut(0, a, PREFIX), cut(a, z, MIDDLE), cut(z, made.n, SUFFIX)
    return prefix + suffix + middle if made.form == "psm" else suffix + prefix + middle


def restored(output: str, form: str) -> str:
    """The text of an output, found from the marks alone."""
    if form == "plain":
        return output
    rest, middle = output.split(MIDDLE)
    one, two = rest.split(SUFFIX if form == "psm" else PREFIX)
    prefix, suffix = (one.removeprefix(PREFIX), two) if form == "psm" else (two, one.removeprefix(SUFFIX))
    return prefix + middle + suffix


def _cut(seed: str, unit: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                text = text or ""
                mark = hashlib.blake2b(f"{doc_id}:{text}".encode(), digest_size=16).digest()
                made = plan(doc_id, text, seed)
                facts = (doc_id, made.n, made.form, made.prefix, made.middle)
                for at, piece in enumerate(pieces_of(text, made, unit)):
                    rows.append((mark, part, at, piece, *(facts if at == 0 else (None,) * 5)))
                if len(rows) >= 10_000:
                    yield _batch(rows, _PIECE)
                    rows = []
            yield _batch(rows, _PIECE)

    return work


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def in_output_order(docs: DataFrame, seed: str = SEED, unit: int = UNIT) -> DataFrame:
    """Pieces of all outputs, each document's together and in order."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = given.mapInArrow(_cut(seed, unit), _PIECE_SQL)
    return pieces.repartition("mark", "part").sortWithinPartitions("mark", "part", "at")


@dataclass
class _Open:
    """A document whose pieces are arriving."""

    key: tuple
    facts: tuple
    copies: int = 0
    last: int = -1
    stretch: int = -1
    place: int = 0


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest outputs, and tell for each piece, from the output alone, where it stands in the text."""
    own: _Open | None = None
    digest = hashlib.sha256()

    def closing() -> tuple:
        return (*own.key, -1, None, *own.facts, -1, own.copies, digest.hexdigest())

    for batch in batches:
        rows = []
        for row in zip(*(batch[name].to_pylist() for name in _PIECE.names), strict=True):
            key, at, piece, facts = row[:2], row[2], row[3], row[4:]
            if own is None or key != own.key:
                if own is not None:
                    rows.append(closing())
                own, digest = _Open(key, facts), hashlib.sha256()
            own.copies += at == 0
            if at == own.last:
                continue  # a repeated row's piece
            own.last = at
            digest.update(piece.encode())
            if own.facts[2] != "plain" and piece[:3] in STRETCH:
                own.stretch, own.place, piece = STRETCH[piece[:3]], 0, piece[3:]
            rows.append((*key, own.place, piece, *(None,) * 5, max(own.stretch, 0), None, None))
            own.place += 1
        yield _batch(rows, _SORTED)
    if own is not None:
        yield _batch([closing()], _SORTED)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest texts, whose pieces come in the order of the text, after a row with what is known of the document."""
    schema = pa.schema([*list(_PIECE)[4:], ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
    facts: tuple | None = None
    copies, output = 0, ""
    digest = hashlib.sha256()
    for batch in batches:
        rows: list[tuple] = []
        columns = (batch[name].to_pylist() for name in ("stretch", "piece", "copies", "output_sha256", *_FACT_NAMES))
        for stretch, piece, n, sha, *told in zip(*columns, strict=True):
            if stretch < 0:
                if facts is not None:
                    rows += [(*facts, output, digest.hexdigest())] * copies
                facts, copies, output, digest = tuple(told), n, sha, hashlib.sha256()
            else:
                digest.update(piece.encode())
        yield _batch(rows, schema)
    if facts is not None:
        yield _batch([(*facts, output, digest.hexdigest())] * copies, schema)


_FACT_NAMES = ("doc_id", "n", "form", "prefix_chars", "middle_chars")


def digests(docs: DataFrame, seed: str = SEED, unit: int = UNIT) -> DataFrame:
    """One row per row of docs(doc_id, text, ..): form, lengths, and digests of the output and of the text restored from it."""
    told = in_output_order(docs, seed, unit).mapInArrow(_assemble, _SORTED_SQL)
    # the same partitions in another order: a sort, no exchange
    return told.sortWithinPartitions("mark", "part", "stretch", "at").mapInArrow(_restore, DIGESTS)


def fill_in_middle(docs: DataFrame, seed: str = SEED, unit: int = UNIT) -> DataFrame:
    """One row per row of docs(doc_id, text, ..): form, lengths and the output text."""
    schema = pa.schema([*list(_PIECE)[4:], ("output", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Open | None = None
        pieces: list[str] = []
        for batch in batches:
            rows: list[tuple] = []
            for row in zip(*(batch[name].to_pylist() for name in _PIECE.names), strict=True):
                if own is None or row[:2] != own.key:
                    if own is not None:
                        rows += [(*own.facts, "".join(pieces))] * own.copies
                    own, pieces = _Open(row[:2], row[4:]), []
                own.copies += row[2] == 0
                if row[2] != own.last:
                    own.last = row[2]
                    pieces.append(row[3])
            yield _batch(rows, schema)
        if own is not None:
            yield _batch([(*own.facts, "".join(pieces))] * own.copies, schema)

    return in_output_order(docs, seed, unit).mapInArrow(work, TEXTS)


def restored_text(output: str, form: str) -> Column:
    """The text of an output column, by its marks."""
    whole, kind = F.col(output), F.col(form)
    first, second = F.substring_index(whole, MIDDLE, 1), F.substring_index(whole, MIDDLE, -1)
    psm = F.concat(F.expr(f"substring(substring_index(substring_index(`{output}`, '{MIDDLE}', 1), '{SUFFIX}', 1), 4)"), second, F.substring_index(first, SUFFIX, -1))
    spm = F.concat(F.substring_index(first, PREFIX, -1), second, F.expr(f"substring(substring_index(substring_index(`{output}`, '{MIDDLE}', 1), '{PREFIX}', 1), 4)"))
    return F.when(kind == "plain", whole).when(kind == "psm", psm).otherwise(spm)
