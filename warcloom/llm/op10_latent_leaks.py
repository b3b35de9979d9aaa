"""Benchmark decontamination by latent semantic retrieval.

Passages are ``2 * HALF`` words of a document, one starting every ``HALF`` words; words are lower-cased (A-Z) and ASCII
punctuation separates them. The columns of the passage matrix are the words of the benchmark items, as only they can match
one; a column's weight is log(n / df) / sqrt(df) with df counted over all half passages, so that words of few passages count
most. Columns of more than ``COMMON`` of all half passages are left out, except that each item keeps its ``LEAST`` rarest.

The leading right singular vectors of the passage matrix A come from one distributed pass of a randomised decomposition:
every task adds up its part of Z = A^T A G, the parts are summed by blocks of columns, and the driver finishes with a matrix
bounded by the items' vocabulary (Nystrom). G starts at the items' own vectors and ``EXTRA`` random ones: among thousands of
rare words the spectrum is flat, and a start by chance alone finds few of the directions that the items need.
Passages and items are compared by the dot product of
their latent coordinates over the norms of their weights. Pairs at ``COSINE`` or more are candidates. A candidate is a leak
if the longest common subsequence of the item and the passage with ``HALF`` words on either side covers ``COVERED`` of the
item's words and ``ANSWER`` of its answer, the item's last quarter (four words at least).

An item that many documents hold has words of many passages, which weigh little or are left out, so its cosine can be small
wherever other items' words stand beside it. So each passage that can hold a leak is a candidate, too, whatever its cosine:
a subsequence that covers ``COVERED`` of an item leaves out no more than the rest, so of the item's rarest words, taken until
they make up that rest and a third of what must be covered, that third must occur around the passage, and of all its words
what must be covered. This bound needs no weight and loses no leak; what it lets through is verified like the others.

Items are a stated query set; they are compared with all passages in blocks of ``ITEMS``, which bounds what is broadcast.

Rules: null and empty texts and items without a word match nothing. Each (row, item) gives one row at most, with the best
of its passages; repeated rows give repeated rows. Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm import rounds
from warcloom.llm.arrays import Words, blocks, give_back

HALF, ITEMS, EXTRA = 32, 256, 24
COMMON, LEAST = 0.004, 12
COSINE, COVERED, ANSWER = 0.4, 0.6, 0.5
BATCH_BYTES = 1 << 21
SCHEMA = "doc_id long, item_id long, cosine double, covered double, answer_covered double"
_COLUMNS, _CELLS = 64, 4096
_CLEAN = bytes(ord(chr(c).lower()) if chr(c).isascii() and chr(c).isalnum() else (c if c >= 128 else 32) for c in range(256))


def clean(text: str | None) -> bytes:
    return (text or "").encode().translate(_CLEAN)


@dataclass
class Space:
    """Words of the items (sorted hashes) and which of them are columns (-1: none); weights, latent vectors of columns and
    items, the items' words, and the bound that every leak keeps."""

    vocabulary: np.ndarray
    place: np.ndarray
    weight: np.ndarray
    basis: np.ndarray
    item_ids: list[int | None]
    item_words: list[np.ndarray]
    items: np.ndarray
    bound: Bound


class Bound:
    """What any passage must hold of each item to be its leak: first by the rarest words of the items, then by all."""

    def __init__(self, item_words: list[np.ndarray], vocabulary: np.ndarray, df: np.ndarray):
        rare, every, k = [], [], len(item_words)
        self.least = np.array([_least(COVERED, len(words)) for words in item_words])
        self.need = np.maximum(1, self.least // 3)
        for item, words in enumerate(item_words):
            own, n = np.unique(np.searchsorted(vocabulary, words), return_counts=True)
            order = np.argsort(df[own], kind="stable")
            rarest = order[: 1 + np.searchsorted(np.cumsum(n[order]), len(words) - self.least[item] + self.need[item])]
            every.append(np.stack([own * k + item, n]))
            rare.append(every[-1][:, rarest])
        self.keys, self.times = _by_first(every)
        column, self.rare_times = _by_first(rare)
        column, self.rare_item = np.divmod(column, k)
        self.begin = np.searchsorted(column, np.arange(len(vocabulary) + 1))
        # a region's halves from its passage's first on; one more stands before
        self.ahead = max(3, -(-(max(map(len, item_words)) + HALF) // HALF))

    def candidates(self, p: _Passages) -> tuple[np.ndarray, np.ndarray]:
        """(passage, item) of p that can be leaks, in order of passages."""
        # empty cells between texts, so that no sum reaches into the next text
        at = np.arange(p.total) + (np.cumsum(np.diff(p.text, prepend=p.text[:1]) != 0)) * self.ahead + 1
        key = _distinct((p.half << 24) + p.column)
        half, column = key >> 24, key & ((1 << 24) - 1)
        where, found = at[half], [np.zeros((2, 0), np.int64)]
        for low in range(0, int(at[-1]) if len(at) else 0, _CELLS):  # passages whose cells are low + 1 .. low + _CELLS
            a, z = np.searchsorted(where, (low, low + _CELLS + self.ahead))
            found.append(self._sums(where[a:z] - low, column[a:z]) + np.array([[low + 1], [0]]))
        cell, item = np.concatenate(found, axis=1)
        passage = np.minimum(np.searchsorted(at, cell), max(p.total - 1, 0))
        real = at[passage] == cell if len(at) else np.zeros(0, bool)  # a cell between texts is no passage
        passage, item = passage[real], item[real]
        held = [self._held(where, column, at[passage[x : x + 4096]], item[x : x + 4096]) for x in range(0, len(passage), 4096)]
        possible = np.concatenate(held) if held else np.zeros(0, bool)
        return passage[possible], item[possible]

    def _sums(self, cell: np.ndarray, column: np.ndarray) -> np.ndarray:
        """(cell - 1, item) around which enough of the item's rarest words occur; a word counts once in each half."""
        k, size = len(self.need), self.begin[column + 1] - self.begin[column]
        which = np.repeat(self.begin[column] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        held = np.bincount(np.repeat(cell, size) * k + self.rare_item[which], weights=self.rare_times[which], minlength=(_CELLS + self.ahead) * k)
        held = held.astype(np.uint16 if held.max() * (self.ahead + 1) < 1 << 16 else np.int64).reshape(-1, k)
        around = sum(held[s : s + _CELLS] for s in range(self.ahead + 1))
        return np.stack(np.divmod(np.flatnonzero(around >= self.need.astype(around.dtype)), k))

    def _held(self, where: np.ndarray, column: np.ndarray, cell: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Whether the region of each (cell, item) holds as many of all words of the item as a leak must have."""
        a, z = np.searchsorted(where, cell - 1), np.searchsorted(where, cell + self.ahead)
        which = np.repeat(a - (np.cumsum(z - a) - (z - a)), z - a) + np.arange((z - a).sum())
        pair = np.repeat(np.arange(len(cell)), z - a)
        key = column[which] * len(self.need) + item[pair]
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        own = self.keys[found] == key
        once = _distinct(pair[own] * len(self.keys) + found[own])
        pair, found = np.divmod(once, len(self.keys))
        return np.bincount(pair, weights=self.times[found], minlength=len(cell)) >= self.least[item]


def _by_first(parts: list[np.ndarray]) -> np.ndarray:
    rows = np.concatenate(parts, axis=1)
    return rows[:, np.argsort(rows[0], kind="stable")]


def _least(share: float, n: int) -> int:
    """The smallest number of n words that is ``share`` of them or more."""
    return next(x for x in range(n + 1) if x / n >= share)


def _distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[np.diff(keys, prepend=-1) != 0]


class _Passages:
    """For a batch of texts: where each word's column occurs. ``half`` numbers the half passages of all texts in order."""

    def __init__(self, texts: list[bytes], columns: np.ndarray):
        self.words = Words(texts)
        w = self.words
        halves = -(-w.counts // HALF)
        self.first = np.cumsum(halves) - halves
        self.total = int(halves.sum())
        self.text = np.repeat(np.arange(len(texts)), halves)
        sieve = np.zeros(1 << 20, bool)
        sieve[columns >> np.uint64(44)] = True
        at = np.flatnonzero(sieve[w.hashes >> np.uint64(44)])
        place = np.minimum(np.searchsorted(columns, w.hashes[at]), len(columns) - 1)
        hit = columns[place] == w.hashes[at] if len(columns) else np.zeros(len(at), bool)
        self.column = place[hit]
        at = at[hit]
        text = np.searchsorted(w.offsets, at, side="right") - 1
        self.half = self.first[text] + (at - w.offsets[text]) // HALF

    def pairs(self, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(passage, column), each once; passage h is half h and the next of the same text. ``place`` renumbers columns."""
        half, column = self.half, self.column
        if place is not None:
            column = place[column]
            half, column = half[column >= 0], column[column >= 0]
        with_before = half[half > 0]
        same = self.text[with_before] == self.text[with_before - 1]
        passage = np.concatenate([half, with_before[same] - 1])
        column = np.concatenate([column, column[half > 0][same]])
        both = _distinct(passage * (1 << 24) + column)
        return both >> 24, both & ((1 << 24) - 1)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    for batch in batches:
        texts, ids = [clean(x) for x in batch["text"].to_pylist()], batch["doc_id"].to_pylist()
        for a, b in blocks(texts, BATCH_BYTES):
            yield ids[a:b], texts[a:b]


def _summed(docs: DataFrame, part) -> dict[int, tuple[np.ndarray, ...]]:
    """Sums over tasks of part(batches) -> {block: arrays}."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = part(batches)
        yield pa.record_batch([pa.array(made, pa.int32()), pa.array([rounds.pack(*x) for x in made.values()], pa.binary())], names=["block", "data"])
        del made
        give_back()

    return rounds.add_up(docs.mapInArrow(work, rounds.SUMS))


def build(docs: DataFrame, items: list[tuple[int | None, bytes]]) -> Space | None:
    """The latent space of all passages over the words of the items."""
    words = [Words([text]).hashes for _, text in items]
    columns = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
    if not len(columns):
        return None
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(columns)

    def frequency(batches: Iterator[pa.RecordBatch]) -> dict:
        df, n = np.zeros(len(shared.value), np.int64), 0
        for _, texts in _texts(batches):
            p = _Passages(texts, shared.value)
            df += np.bincount(_distinct(p.half * (1 << 24) + p.column) & ((1 << 24) - 1), minlength=len(df))
            n += p.total
        return {0: (df, np.array([n]))}

    got = _summed(docs, frequency)
    if not got or not got[0][1][0]:
        return None
    df, n = got[0][0], int(got[0][1][0])
    keep = df <= max(50, COMMON * n)
    for w in words:
        own = np.unique(np.searchsorted(columns, w))
        keep[own[np.argsort(df[own], kind="stable")[:LEAST]]] = True
    vocabulary, bound = columns, Bound(words, columns, df)
    place = np.where(keep, np.cumsum(keep) - 1, -1)
    columns, df = columns[keep], np.maximum(df[keep], 1)
    weight = (np.log(1 + n / df) / np.sqrt(df)).astype(np.float32)
    own = [_own(w, columns) for w in words]
    norm = np.array([max(np.sqrt((weight[x].astype(np.float64) ** 2).sum()), 1e-30) for x in own])
    start = np.random.default_rng(3).standard_normal((len(columns), len(items) + EXTRA)).astype(np.float32) / np.float32(np.sqrt(len(columns)))
    for k, x in enumerate(own):
        start[:, k] = 0
        start[x, k] = weight[x] / norm[k]
    shared = spark.sparkContext.broadcast((columns, weight, start))

    def gram(batches: Iterator[pa.RecordBatch]) -> dict:
        columns, weight, start = shared.value
        weighted = start * weight[:, None]
        z = np.zeros_like(weighted)
        for _, texts in _texts(batches):
            passage, column = _Passages(texts, columns).pairs()
            for a in range(0, len(passage), 1 << 16):
                _add_gram(z, weighted, weight, passage[a : a + (1 << 16)], column[a : a + (1 << 16)])
        return {k: (z[k * _COLUMNS : (k + 1) * _COLUMNS],) for k in range(-(-len(z) // _COLUMNS))}

    parts = _summed(docs, gram)
    z = np.concatenate([parts[k][0] for k in sorted(parts)]).astype(np.float64)
    basis = _nystrom(z, start.astype(np.float64))
    coordinates = np.stack([(basis[x] * weight[x, None]).sum(axis=0) / n for x, n in zip(own, norm, strict=True)])
    return Space(vocabulary, place, weight, basis.astype(np.float32), [i for i, _ in items], words, coordinates.astype(np.float32), bound)


def _own(words: np.ndarray, columns: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(columns, words), len(columns) - 1)
    return np.unique(at[columns[at] == words])


def _add_gram(z: np.ndarray, weighted: np.ndarray, weight: np.ndarray, passage: np.ndarray, column: np.ndarray) -> None:
    """z += A^T (A start) for some passages, given as sorted (passage, column)."""
    if not len(passage):
        return
    new = np.flatnonzero(np.diff(passage, prepend=-1))
    row = np.cumsum(np.diff(passage, prepend=passage[0]) != 0)
    y = _row_sums(weighted, column, new)
    order = np.argsort(column, kind="stable")
    starts = np.flatnonzero(np.diff(column[order], prepend=-1))
    used = column[order][starts]
    z[used] += _row_sums(y, row[order], starts) * weight[used, None]


def _row_sums(matrix: np.ndarray, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each stretch of ``rows`` the sum of these rows of a matrix; a stretch ends where the next begins.

    The first rows of all stretches are added at once, then the second ones, and so on; a long stretch is summed alone.
    """
    out = np.zeros((len(begin), matrix.shape[1]), matrix.dtype)
    size = np.diff(np.append(begin, len(rows)))
    order = np.argsort(-size, kind="stable")
    single = int((size > 256).sum())
    for k in order[:single]:
        out[k] = matrix[rows[begin[k] : begin[k] + size[k]]].sum(axis=0)
    order = order[single:]
    begin, size = begin[order], size[order]
    part = np.zeros((len(order), matrix.shape[1]), matrix.dtype)
    for j in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -j))
        part[:n] += matrix[rows[begin[:n] + j]]
    out[order] = part
    return out


def _nystrom(z: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Leading eigenvectors of M from z = M start; as many as the start has independent columns."""
    shift = 1e-9 * max(np.linalg.norm(z), 1e-30)
    z = z + shift * start
    values, vectors = np.linalg.eigh((start.T @ z + z.T @ start) / 2)
    good = values > values.max() * 1e-9
    left, _, _ = np.linalg.svd(z @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return left


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, with one bit per element of a."""
    where: dict = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        if m := where.get(x):
            u = v & m
            v = (v + u) | (v - u)
            v &= full
    return len(a) - v.bit_count()


def _leaks(space: Space, ids: list, texts: list[bytes]) -> list[tuple]:
    p = _Passages(texts, space.vocabulary)
    passage, column = p.pairs(space.place)
    new = np.flatnonzero(np.diff(passage, prepend=-1))
    possible_passage, possible_item = space.bound.candidates(p)
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    weighted = space.basis * space.weight[:, None]

    def verify(h: int, k: int, cosine: float) -> None:
        t = int(p.text[h])
        item = space.item_words[k].tolist()
        at = int(p.words.offsets[t]) + (h - int(p.first[t])) * HALF
        low, high = max(at - HALF, int(p.words.offsets[t])), min(at + 3 * HALF, int(p.words.offsets[t + 1]))
        region = p.words.hashes[low : max(high, min(at + len(item) + HALF, int(p.words.offsets[t + 1])))].tolist()
        covered = common_subsequence(item, region) / len(item)
        answer = item[-max(4, len(item) // 4) :]
        if covered >= COVERED and (told := common_subsequence(answer, region) / len(answer)) >= ANSWER:
            found[t, k] = max(found.get((t, k), (0, 0, 0)), (covered, told, cosine))

    for a in range(0, len(new), 4096):
        begin = new[a : a + 4096]
        last = new[a + 4096] if a + 4096 < len(new) else len(passage)
        own = column[begin[0] : last]
        w = space.weight[own]
        latent = _row_sums(weighted, own, begin - begin[0])
        norm = np.sqrt(np.add.reduceat(w * w, begin - begin[0]))
        cosine = latent @ space.items.T / norm[:, None]
        candidate = cosine >= COSINE
        first, end = np.searchsorted(possible_passage, (passage[begin[0]], passage[last - 1] + 1))
        row = np.minimum(np.searchsorted(passage[begin], possible_passage[first:end]), len(begin) - 1)
        there = passage[begin[row]] == possible_passage[first:end]
        candidate[row[there], possible_item[first:end][there]] = True
        for r, k in zip(*np.nonzero(candidate), strict=True):
            verify(int(passage[begin[r]]), int(k), float(cosine[r, k]))
    # passages without a column have no cosine
    for i in np.flatnonzero(~np.isin(possible_passage, passage[new])):
        verify(int(possible_passage[i]), int(possible_item[i]), 0.0)
    return [(ids[t], space.item_ids[k], cos, covered, told) for (t, k), (covered, told, cos) in sorted(found.items())]


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text, ..) and item of benchmark(item_id, text) that it holds."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for space in _spaces(docs, benchmark):
        out = out.unionByName(_search(docs, space))
    return out


def _spaces(docs: DataFrame, benchmark: DataFrame) -> Iterator[Space]:
    items = [(r.item_id, clean(r.text)) for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text").toLocalIterator()]
    for a in range(0, len(items), ITEMS):
        space = build(docs, [x for x in items[a : a + ITEMS] if x[1].split()])
        if space is not None:
            yield space


def _search(docs: DataFrame, space: Space) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _texts(batches):
            columns = list(zip(*_leaks(shared.value, ids, texts), strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "cosine", "covered", "answer_covered"])
        give_back()

    return docs.mapInArrow(work, SCHEMA)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows whose text holds an item; rows and columns as they are. Each row is judged by its own text, so
    rows without doc_id, or with a repeated one, stay if they are clean. Nothing is shuffled."""
    out = docs
    for space in _spaces(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark):
        out = _clean_rows(out, space)
    return out


def _clean_rows(docs: DataFrame, space: Space) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, at = np.ones(batch.num_rows, bool), 0
            for ids, texts in _texts([batch]):
                keep[[row for row, *_ in _leaks(shared.value, list(range(at, at + len(ids))), texts)]] = False
                at += len(ids)
            yield batch.filter(pa.array(keep))
        give_back()

    return docs.mapInArrow(work, docs.schema)
