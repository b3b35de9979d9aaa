"""Question-and-answer rounds between parts of a document table and buckets of a key space.

Documents are dealt to parts by a hash of their id. In a round each part sends what it asks (hashes, each once, sorted) to
the bucket of each hash; a bucket answers every part in the order of its question, so an answer needs no keys. Rows of a
shuffle are packed arrays, so a round moves a few bytes per question and costs no row handling. A key that a third of all
documents hold is asked once per part, so no bucket gets more of it than there are parts.

Parts hold about ``PART_BYTES`` of text, so their number follows the data; a bucket gets what as many parts send. Rows
without id, which may be many, are dealt by the hash of their text in ascending order: a part of a higher number holds the
later ones, so parts decide between rows without id just as their order within a part does.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm.arrays import give_back

PART_BYTES = 12_000_000
LANES = 512
SUMS = "block int, data binary"
NO_ID = np.iinfo(np.int64).min
LETTER = "bucket int, part int, kind int, data binary"
_LETTER = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])


def pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def unpack(data: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def keyed(docs: DataFrame) -> tuple[DataFrame, int]:
    """(part, doc_id, text) of each document, and the number of parts. Null texts are kept as null."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES), 1)
    by_text = f"least({parts - 1}, CAST(floor((CAST(xxhash64(coalesce(text, '')) AS double) / 18446744073709551616D + 0.5D) * {parts}) AS int))"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    part = F.expr(f"IF(doc_id IS NULL, {by_text}, CAST(pmod(xxhash64(doc_id), {parts}L) AS int))")
    return rows.select(part.alias("part"), "doc_id", "text"), parts


def text_order(text: bytes) -> int:
    """What rows without id are ordered by before their text: its hash, as Spark's xxhash64 has it."""
    found = xxhash.xxh64_intdigest(text, seed=42)
    return found - (1 << 64) if found >> 63 else found


class Part:
    """Rows of one part in a fixed order, which every round finds again: rows without id first, by hash of the text, then by
    text; the others by doc_id, then text, null before empty.

    Rows with the text of an earlier row are ``copies`` of it. ``texts`` are UTF-8 bytes, null as empty.
    """

    def __init__(self, rows: pa.Table):
        ids = rows["doc_id"].to_pylist()
        texts = [None if x is None else x.encode() for x in rows["text"].to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (*((NO_ID, text_order(texts[i] or b"")) if ids[i] is None else (ids[i], 0)), texts[i] or b"", texts[i] is not None))
        self.part = rows["part"][0].as_py() if len(ids) else -1
        self.ids = [ids[i] for i in order]
        self.nulls = [texts[i] is None for i in order]
        self.texts = [texts[i] or b"" for i in order]
        first: dict[bytes, int] = {}
        self.first = [first.setdefault(x, k) for k, x in enumerate(self.texts)]
        self.distinct = [k for k, x in enumerate(self.first) if x == k]
        self.keys = np.array([NO_ID if x is None else x for x in self.ids], dtype=np.int64)


def letters(rows: Iterable[tuple[int, int, int, bytes]]) -> pa.Table:
    rows = list(rows)
    made = pa.table({f.name: pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_LETTER)}, schema=_LETTER)
    del rows
    give_back()
    return made


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in four bytes each where they fit, else in eight."""
    return counts.astype(np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64)


def squeeze(hashes: np.ndarray, width: int = 6) -> tuple[np.ndarray, ...]:
    """Sorted 64-bit numbers as differences, in ``width`` bytes each where they fit."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    if len(steps) < 2 or steps[1:].max() >= 1 << 8 * width:
        return (steps,)
    return steps[:1], np.ascontiguousarray(steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def widen(packed: tuple[np.ndarray, ...], width: int = 6) -> np.ndarray:
    if len(packed) == 1:
        return np.cumsum(packed[0], dtype=np.uint64)
    wide = np.zeros((len(packed[1]), 8), np.uint8)
    wide[:, :width] = packed[1]
    return np.cumsum(np.concatenate([packed[0], wide.view("<u8").ravel()]), dtype=np.uint64)


def ask(docs: DataFrame, answers: DataFrame | None, question: Callable[[Part, dict], Iterable[tuple[int, int, int, bytes]]]) -> DataFrame:
    """Letters that the parts write, each knowing the answers of the round before as {kind: [(bucket, data), ..]}."""
    if answers is None:
        return docs.groupBy("part").applyInArrow(lambda rows: letters(question(Part(rows), {})), LETTER)

    def work(rows: pa.Table, got: pa.Table) -> pa.Table:
        return letters(question(Part(rows), mail(got)) if rows.num_rows else ())

    return docs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(work, LETTER)


def answer(asked: DataFrame, reply: Callable[[list[tuple[int, int, bytes]]], Iterable[tuple[int, int, bytes]]]) -> DataFrame:
    """Letters back: ``reply`` gets (part, kind, data) of all letters to a bucket and gives (part, kind, data)."""

    def work(rows: pa.Table) -> pa.Table:
        bucket = rows["bucket"][0].as_py()
        got = sorted(zip(rows["part"].to_pylist(), rows["kind"].to_pylist(), rows["data"].to_pylist(), strict=True), key=lambda r: r[:2])
        return letters((bucket, part, kind, data) for part, kind, data in reply(got))

    return asked.groupBy("bucket").applyInArrow(work, LETTER)


def finish(docs: DataFrame, answers: DataFrame, result: Callable[[Part, dict], pa.Table], schema: str) -> DataFrame:
    """Rows that parts make of their documents and the last answers."""
    def work(rows: pa.Table, got: pa.Table) -> pa.Table:
        made = result(Part(rows), mail(got))
        give_back()
        return made

    return docs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(work, schema)


def mail(got: pa.Table) -> dict[int, dict[int, bytes]]:
    """{kind: {bucket: data}}"""
    out: dict[int, dict[int, bytes]] = {}
    for bucket, kind, data in zip(got["bucket"].to_pylist(), got["kind"].to_pylist(), got["data"].to_pylist(), strict=True):
        out.setdefault(kind, {})[bucket] = data
    return out


def add_up(sums: DataFrame) -> dict[int, tuple[np.ndarray, ...]]:
    """{block: arrays} from packed arrays that tasks give per block (``SUMS``). Tasks are first added up in ``LANES`` groups,
    so no group gets an array from every task."""

    def add(rows: pa.Table) -> pa.Table:
        total = None
        for data in rows["data"]:
            own = unpack(data.as_py())
            total = own if total is None else tuple(a + b for a, b in zip(total, own, strict=True))
        return pa.table([rows["block"][:1], pa.array([pack(*total)], pa.binary())], names=["block", "data"])

    lanes = sums.withColumn("lane", F.expr(f"pmod(spark_partition_id(), {LANES})"))
    once = lanes.groupBy("block", "lane").applyInArrow(add, SUMS)
    return {r.block: unpack(r.data) for r in once.groupBy("block").applyInArrow(add, SUMS).collect()}


def bucket_count(docs: DataFrame, parts: int) -> int:
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts // 4)


def slices(hashes: np.ndarray, buckets: int) -> Iterable[tuple[int, int, int]]:
    """(bucket, start, end) in sorted hashes, for the buckets that have some. A bucket is a range of hashes."""
    edges = np.arange(1, buckets, dtype=np.uint64) * np.uint64((2**64 - 1) // buckets + 1)
    cuts = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]]).tolist()
    return [(b, a, z) for b, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)) if z > a]


def bits(answers: dict[int, bytes], hashes: np.ndarray, buckets: int, which: int = 0) -> np.ndarray:
    """The bit that came back for each of the sorted hashes; of several bits, the one asked for."""
    out = np.zeros(len(hashes), bool)
    for b, a, z in slices(hashes, buckets):
        out[a:z] = np.unpackbits(unpack(answers[b])[which], count=z - a)
    return out


def deal(flags: tuple[np.ndarray, ...], to: list[tuple[int, int, int]]) -> Iterable[tuple[int, int, bytes]]:
    """Flags in the order of the letters (part, kind, length) as packed bits for each."""
    at = 0
    for part, kind, n in to:
        yield part, kind, pack(*(np.packbits(f[at : at + n]) for f in flags))
        at += n


def starts_run(*columns: np.ndarray) -> np.ndarray:
    """Which entries of sorted columns differ from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def earliest(got: list[tuple[int, int, bytes]], of: int) -> Iterable[tuple[int, int, bytes]]:
    """For each (hash, check, id) in letters of one kind: does a smaller id come with the same hash and check? Of equal ids,
    which only rows without id have in several parts, that of the first part counts as smaller."""
    asked = [(part, *unpack(data)) for part, kind, data in got if kind == of]
    if asked:
        hashes, checks, ids = (np.concatenate([x[k] for x in asked]) for k in (1, 2, 3))
        order = np.lexsort((ids, checks, hashes))
        late = np.zeros(len(order), bool)
        late[order] = ~starts_run(hashes[order], checks[order])
        yield from deal((late,), [(x[0], of, len(x[1])) for x in asked])


def seen_elsewhere(got: list[tuple[int, int, bytes]]) -> Iterable[tuple[int, int, bytes]]:
    """For each hash asked about: does another part ask about it, too?"""
    asked = [widen(unpack(data)) for _, _, data in got]
    hashes = np.concatenate(asked)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    yield from deal((twice,), [(part, kind, len(x)) for (part, kind, _), x in zip(got, asked, strict=True)])
