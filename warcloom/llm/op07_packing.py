"""Best-fit packing of token sequences into bins with several capacities.

Each bin has three: tokens, pieces and attention cost (the sum of squared piece lengths). Pieces come in descending
length; a piece goes to the open bin that holds it under every capacity and where the weighted norm of what is left is
smallest (or, ``select='dot'``, where the weighted dot product of what is left and what is needed is largest); a new bin
is opened only if none holds it. A document longer than a bin is cut into whole bins and a last piece; shorter ones are
never cut.

At scale: pieces are dealt at random to groups of about ``group_pieces``, each packed by one task. Bins that are not full
enough are opened again and their pieces packed together in a next round of fewer groups, until one group is left or a
round no longer shrinks. Only lengths move; texts are read once.

Rules: null is an empty text, which is one piece with the end id alone. Rows that share a doc_id are packed each for
itself. An empty table gives no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm.arrays import give_back
from warcloom.llm.stored import stored
from warcloom.llm.tokens import WordEncoder, default_path

TOKENS, END_ID = 4096, 1
GROUP_PIECES = 20_000
FULL = 0.995
_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("deal", pa.int64())])
_PLACED = pa.schema([*_PIECE, ("bin", pa.int64()), ("offset", pa.int64()), ("fill", pa.int64())])
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"
PLACED = PIECE + ", bin long, offset long, fill long"


def pieces(docs: DataFrame, path: str, tokens: int = TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``tokens`` ids of each document; ``deal`` is a random number that a retry gives again."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, seen = WordEncoder.of(path), end_id.to_bytes(4, "little"), 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = encoder.ids(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * tokens)):
                    own = ids[at : at + 4 * tokens]
                    seen += 1
                    rows.append((doc_id, k, at // 4, len(own) // 4, zlib.crc32(own), zlib.crc32(b"%d %d" % (seen, zlib.crc32(own)))))
            columns = list(zip(*rows, strict=True)) or [()] * len(_PIECE)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _PIECE, strict=True)], schema=_PIECE)
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, PIECE)


def best_fit(needs: np.ndarray, capacity: np.ndarray, weights: np.ndarray, select: str = "norm") -> np.ndarray:
    """Bin of each item, items given in the order of packing; rows of ``needs`` are items, columns resources."""
    out, used, smallest = np.empty(len(needs), np.int64), 0, np.minimum.accumulate(needs[::-1], axis=0)[::-1]
    room = np.zeros((1024, len(capacity)))
    which = np.zeros(1024, np.int64)
    n = 0
    scale = weights / capacity**2
    for k, need in enumerate(needs):
        if k % 1024 == 0:  # bins that no later item fits go out of sight
            keep = (room[:n] >= smallest[k]).all(axis=1)
            kept, numbers = room[:n][keep], which[:n][keep]
            n = len(kept)
            room[:n], which[:n] = kept, numbers
        rest = room[:n] - need
        fits = np.flatnonzero((rest >= 0).all(axis=1))
        if len(fits):
            score = (rest[fits] ** 2 @ scale) if select == "norm" else -(room[fits] * need) @ scale
            at = fits[np.argmin(score)]
        else:
            if n == len(room):
                room, which = np.concatenate([room, np.zeros_like(room)]), np.concatenate([which, np.zeros_like(which)])
            at, n = n, n + 1
            room[at], which[at] = capacity, used
            used += 1
        room[at] -= need
        out[k] = which[at]
    return out


def pack(items: DataFrame, tokens: int = TOKENS, most_pieces: int = TOKENS, attention: int = TOKENS**2, weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6), select: str = "norm", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset. ``items`` as from ``pieces``; ``weights`` of tokens, pieces and attention cost."""
    capacity = np.array([tokens, most_pieces, attention], float)

    def one_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("deal", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        length = rows["length"].to_numpy().astype(float)
        bins = best_fit(np.stack([length, np.ones_like(length), length**2], axis=1), capacity, np.array(weights), select)
        order = np.argsort(bins, kind="stable")
        size = length[order].astype(np.int64)
        begin = np.cumsum(size) - size
        offset = np.empty(len(size), np.int64)
        offset[order] = begin - begin[np.searchsorted(bins[order], bins[order])]
        fill = np.bincount(bins, weights=length).astype(np.int64)[bins]
        return pa.table([rows[f.name] for f in _PIECE] + [pa.array(bins), pa.array(offset), pa.array(fill)], schema=_PLACED)

    loose, done, turn = stored(items), [], 0
    n = loose.count()
    while True:
        groups = max(1, -(-n // group_pieces))
        dealt = loose.withColumn("group", F.expr(f"pmod(xxhash64(deal, {turn}), {groups}L)"))
        placed = dealt.groupBy("group").applyInArrow(lambda key, rows: one_group(rows).append_column("group", pa.repeat(key[0].as_py(), rows.num_rows)), PLACED + ", group long")
        placed = stored(placed.withColumn("turn", F.lit(turn)))
        if groups == 1:
            done.append(placed)
            break
        again = placed.where(F.col("fill") < int(FULL * tokens))
        left = again.count()
        if left > 0.7 * n:
            done.append(placed)
            break
        done.append(placed.where(F.col("fill") >= int(FULL * tokens)))
        loose, n, turn = again.select(*_PIECE.names), left, turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    sequence = F.expr("turn * 72057594037927936L + group * 16777216L + bin").alias("sequence_id")
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", sequence, "offset")


def pack_documents(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """One row per piece of docs(doc_id, text, ..): where it lies in which sequence."""
    return pack(pieces(docs, path or default_path()), **options)
