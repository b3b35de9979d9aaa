"""Language-model scores by a hidden Markov model.

Words are counted over the whole corpus in one round (``rounds``), so every part knows the training count of each of its
words. The ``TOP`` most frequent words are symbols of their own; any other word is the symbol of its ending (last three
bytes, in ``CLASSES`` classes) times the word's share of its class, (c + 1) / (N + V + 1) with the class's tokens N and
types V, which leaves one share for unseen words. The model over symbols has ``STATES`` latent states. Baum-Welch trains
it: each task runs scaled forward and backward recursions over its training texts and adds up expected counts; those are
summed by blocks of symbols across tasks, and the driver gets a table whose size the parameters bound. Training starts
from clusters of all training segments: by the signs of their leading principal components over the ``FREQUENT`` most
frequent symbols, then by the nearest of the clusters' means (``CLUSTER_ROUNDS`` passes in all); ``ROUNDS`` rounds of Baum-Welch
follow. Each covers all training texts. A score is the exact log10 likelihood of the text and its end by the scaled
forward recursion.

Training texts are those with crc32(doc_id as text) mod 7 other than 2 (a null doc_id trains). A text of more than
``SEGMENT`` tokens is trained in segments, and scored whole. Words are compared by 64-bit hashes.

Rules: null is an empty text, which is one end token. Rows with equal texts are scored alike and each counts in training.
Without training texts every word is unknown (base 0). An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from warcloom.llm import rounds
from warcloom.llm.arrays import Words, mix
from warcloom.llm.stored import stored

TOP, CLASSES, STATES = 6144, 1024, 8
ROUNDS, FREQUENT, CLUSTER_ROUNDS = 2, 256, 4
SEGMENT, BATCH = 100_000, 200_000
SYMBOLS = TOP + CLASSES + 1
END = SYMBOLS - 1
PRIOR = 50.0
SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_ENCODED = "part int, data binary"
_BLOCK = 256


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class _Texts:
    """Distinct texts of a part in lower case (A-Z), their words, and how many training rows each has."""

    def __init__(self, part: rounds.Part, buckets: int):
        self.part, self.buckets = part, buckets
        self.words = Words([part.texts[k].lower() for k in part.distinct], with_tails=True)
        self.held = np.array([held_out(x) for x in part.ids], bool)
        slot = {k: i for i, k in enumerate(part.distinct)}
        self.slot = np.array([slot[k] for k in part.first], np.int64)
        self.weight = np.bincount(self.slot[~self.held], minlength=len(part.distinct))
        self.sorted, first, self.back = np.unique(self.words.hashes, return_index=True, return_inverse=True)
        self.classes = (mix(self.words.tails[first].astype(np.uint64)) % np.uint64(CLASSES)).astype(np.uint16)
        self.counts = np.bincount(self.back, weights=np.repeat(self.weight, self.words.counts), minlength=len(self.sorted)).astype(np.int64)

    def ask_counts(self):
        for b, a, z in rounds.slices(self.sorted, self.buckets):
            yield b, self.part.part, 0, rounds.pack(rounds.narrow(self.counts[a:z]), self.classes[a:z], *rounds.squeeze(self.sorted[a:z]))
        yield self.part.part % self.buckets, self.part.part, 1, rounds.pack(np.array([self.weight.sum()]))

    def encode(self, got: dict, model: _Vocabulary) -> bytes:
        count = np.zeros(len(self.sorted), np.int64)
        for b, a, z in rounds.slices(self.sorted, self.buckets):
            count[a:z] = rounds.unpack(got[0][b])[0]
        at = np.minimum(np.searchsorted(model.top, self.sorted), max(len(model.top) - 1, 0))
        own = model.top[at] == self.sorted if len(model.top) else np.zeros(len(self.sorted), bool)
        symbol = np.where(own, at, TOP + self.classes).astype(np.uint16)
        within = np.where(own, 0.0, np.log10((count + 1) / (model.tokens + model.types + 1)[self.classes]))
        base = np.log10((count + 1) / (model.n + model.v + 1))
        sums = lambda x: np.add.reduceat(np.append(x[self.back], 0), self.words.offsets[:-1]) * (self.words.counts > 0) if len(self.words.counts) else np.zeros(0)
        ends = np.log10((model.ends + 1) / (model.n + model.v + 1))
        ids = np.array([0 if x is None else x for x in self.part.ids], np.int64)
        null = np.array([x is None for x in self.part.ids], bool)
        known = sums((count > 0).astype(np.int64)).astype(np.int64) + int(model.ends > 0)
        return rounds.pack(ids, null, self.held, self.slot, self.weight, self.words.counts, known, sums(base) + ends, sums(within), symbol[self.back])


class _Vocabulary:
    """What all parts need of the counts: bounded by TOP and CLASSES, whatever the corpus."""

    def __init__(self, top: np.ndarray, count: np.ndarray, tokens: np.ndarray, types: np.ndarray, n: int, v: int, ends: int):
        order = np.argsort(top)
        self.top, self.tokens, self.types, self.n, self.v, self.ends = top[order], tokens, types, n, v, ends
        symbols = np.concatenate([count[order], np.zeros(TOP - len(top), np.int64), tokens, [ends]])
        self.frequent = np.argsort(-symbols, kind="stable")[:FREQUENT]


def _count(got: list[tuple[int, int, bytes]]):
    """Training counts back to each part; to part -1 the bucket's sums and its most frequent words."""
    asked = [(part, *rounds.unpack(data)) for part, kind, data in got if kind == 0]
    ends = sum(int(rounds.unpack(data)[0][0]) for _, kind, data in got if kind == 1)
    if not asked:
        yield -1, 0, rounds.pack(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64), np.array([ends]))
        return
    hashes = np.concatenate([rounds.widen(x[3:]) for x in asked])
    counts = np.concatenate([x[1] for x in asked]).astype(np.int64)
    unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    total = np.bincount(back, weights=counts, minlength=len(unique)).astype(np.int64)
    at = 0
    for x in asked:
        yield x[0], 0, rounds.pack(rounds.narrow(total[back[at : at + len(x[1])]]))
        at += len(x[1])
    classes = np.concatenate([x[2] for x in asked])[first]
    most = np.lexsort((unique, -total))[:TOP]
    most = most[total[most] > 0]
    tokens = np.bincount(classes, weights=total, minlength=CLASSES).astype(np.int64)
    types = np.bincount(classes[total > 0], minlength=CLASSES)
    yield -1, 0, rounds.pack(unique[most], total[most], classes[most], tokens, types, np.array([ends]))


def _vocabulary(answers: DataFrame) -> _Vocabulary:
    """The most frequent words of all buckets' most frequent ones, and the classes without them."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array([x], pa.binary()) for x in [_merge([y for b in batches for y in b["data"].to_pylist()])]], names=["data"])

    rows = answers.where("part = -1").select("data")
    while rows.rdd.getNumPartitions() > 8:  # a tree of merges, so that the driver gets a few tables of bounded size
        rows = stored(rows.mapInArrow(merge, "data binary").repartition(max(1, rows.rdd.getNumPartitions() // 16)))
    top, count, classes, tokens, types, ends = rounds.unpack(_merge([r.data for r in rows.collect()]))
    n, v, ends = int(tokens.sum() + ends[0]), int(types.sum() + (ends[0] > 0)), int(ends[0])
    np.subtract.at(tokens, classes, count)
    np.subtract.at(types, classes, 1)
    return _Vocabulary(top, count, tokens, types, n, v, ends)


def _merge(tables: list[bytes]) -> bytes:
    got = [rounds.unpack(x) for x in tables]
    if not got:
        return rounds.pack(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint16), np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64), np.array([0]))
    top, count, classes = (np.concatenate([x[k] for x in got]) for k in range(3))
    most = np.lexsort((top, -count))[:TOP]
    return rounds.pack(top[most], count[most], classes[most], *(sum(x[k] for x in got) for k in (3, 4, 5)))


class Chain:
    """Start, transition and emission probabilities; emission is symbol x state."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = (np.asarray(x, np.float32) for x in (start, move, emit))

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Chain:
        """From expected counts. Emissions lean on the states' common distribution, so none is zero."""
        common = emit.sum(axis=1) + 1.0
        emit = emit + PRIOR * (common / common.sum())[:, None]
        start, move = start + 1.0, move + 1.0 + 9.0 * np.eye(len(start))
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    def log10(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 likelihood of each sequence of symbols, by the scaled forward recursion."""
        out = np.zeros(len(sequences))
        for which, grid, live in _grids(sequences):
            alpha, total = None, np.zeros(len(which))
            for t in range(grid.shape[0]):
                n = live[t]
                seen = self.emit[grid[t, :n]]
                alpha = (self.start if alpha is None else alpha[:n] @ self.move) * seen
                scale = alpha.sum(axis=1, keepdims=True)
                alpha /= scale
                total[:n] += np.log10(scale[:, 0], dtype=np.float64)
            out[which] = total
        return out

    def expect(self, sequences: list[np.ndarray], weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected counts of starts, moves and emissions, by forward and backward recursions."""
        k = len(self.start)
        start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((SYMBOLS, k))
        for which, grid, live in _grids(sequences):
            length = grid.shape[0]
            alphas, scales, w = [], [], weight[which].astype(np.float32)
            alpha = None
            for t in range(length):
                n = live[t]
                alpha = (self.start if alpha is None else alpha[:n] @ self.move) * self.emit[grid[t, :n]]
                scale = alpha.sum(axis=1, keepdims=True)
                alpha /= scale
                alphas.append(alpha)
                scales.append(scale)
            beta = np.zeros((0, k), np.float32)
            seen, posts = [], []
            for t in range(length - 1, -1, -1):
                n = live[t]
                grown = np.ones((n, k), np.float32)
                if t + 1 < length:
                    m = live[t + 1]
                    ahead = self.emit[grid[t + 1, :m]] * beta / scales[t + 1]
                    grown[:m] = ahead @ self.move.T
                    move += (alphas[t][:m] * w[:m, None]).T @ ahead
                beta = grown
                posts.append(alphas[t] * beta * w[:n, None])
                seen.append(grid[t, :n])
            start += posts[-1].sum(axis=0)
            symbols, posts = np.concatenate(seen), np.concatenate(posts)
            for j in range(k):
                emit[:, j] += np.bincount(symbols, weights=posts[:, j], minlength=SYMBOLS)
        return start, move * self.move, emit


def _grids(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sequences of like length together: their places, symbols by time, and how many still live at each time."""
    size = np.array([len(x) for x in sequences], np.int64)
    order = np.argsort(-size, kind="stable")
    at = 0
    while at < len(order):
        longest = int(size[order[at]])
        n = max(1, BATCH // max(longest, 1))
        which = order[at : at + n]
        which = which[: max(1, int((size[which] * 2 >= longest).sum()))]
        at += len(which)
        grid = np.zeros((longest, len(which)), np.uint16)
        for j, k in enumerate(which):
            grid[: size[k], j] = sequences[k]
        yield which, grid, np.searchsorted(-size[which], -np.arange(longest), side="left")


def _sequences(blob: tuple) -> list[np.ndarray]:
    counts, symbols = blob[5], blob[9]
    ends = np.cumsum(counts)
    return [np.append(symbols[z - n : z], np.uint16(END)) for n, z in zip(counts.tolist(), ends.tolist(), strict=True)]


def _segments(blob: tuple) -> list[tuple[np.ndarray, int]]:
    """Segments of the training texts, with the number of rows that have the text."""
    return [(x[a : a + SEGMENT], w) for x, w in zip(_sequences(blob), blob[4], strict=True) if w for a in range(0, len(x), SEGMENT)]


def _points(blob: tuple, frequent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Training segments some at a time: symbols, their segments, weights, and square roots of the frequent symbols' shares."""
    place = np.full(SYMBOLS, len(frequent))
    place[frequent] = np.arange(len(frequent))
    own, size = _segments(blob), 0
    ends = np.cumsum([len(x) for x, _ in own])
    while size < len(own):
        a, size = size, max(size + 1, int(np.searchsorted(ends, (ends[size - 1] if size else 0) + 10 * BATCH)))
        part = own[a:size]
        length = np.array([len(x) for x, _ in part])
        symbols, row = np.concatenate([x for x, _ in part]), np.repeat(np.arange(len(part)), length)
        counts = np.bincount(row * (len(frequent) + 1) + place[symbols], minlength=len(part) * (len(frequent) + 1))
        yield symbols, row, np.array([w for _, w in part], float), np.sqrt(counts.reshape(len(part), -1)[:, :-1] / length[:, None])


def _summed(encoded: DataFrame, table: Callable[[tuple], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of a vector and a table over all parts, the table by blocks of rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for data in batch["data"].to_pylist():
                made = table(rounds.unpack(data))
                sums = made if sums is None else tuple(x + y for x, y in zip(sums, made, strict=True))
        if sums is not None:
            blocks = [rounds.pack(sums[0]), *(rounds.pack(sums[1][a : a + _BLOCK]) for a in range(0, len(sums[1]), _BLOCK))]
            yield pa.record_batch([pa.array(range(-1, len(blocks) - 1), pa.int32()), pa.array(blocks, pa.binary())], names=["block", "data"])

    got = rounds.add_up(encoded.mapInArrow(work, rounds.SUMS))
    return got[-1][0], np.concatenate([got[k][0] for k in sorted(got) if k >= 0])


def _first_chain(encoded: DataFrame, words: _Vocabulary) -> Chain:
    """From clusters of all training segments, one per state; sums of bounded size reach the driver."""
    if not words.ends:
        return Chain(np.ones(STATES) / STATES, np.ones((STATES, STATES)) / STATES, np.ones((SYMBOLS, STATES)) / SYMBOLS)
    frequent, width = words.frequent, len(words.frequent)

    def moments(blob: tuple) -> tuple[np.ndarray, np.ndarray]:
        first, second = np.zeros(width + 1), np.zeros((width, width))
        for _, _, w, points in _points(blob, frequent):
            first += np.append(w @ points, w.sum())
            second += (points * w[:, None]).T @ points
        return first, second

    first, second = _summed(encoded, moments)
    mean = first[:-1] / first[-1]
    axes = np.linalg.eigh(second / first[-1] - np.outer(mean, mean))[1][:, ::-1][:, : (STATES - 1).bit_length()]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    label = lambda points: ((points - mean) @ axes > 0) @ (1 << np.arange(axes.shape[1])) % STATES
    for _ in range(CLUSTER_ROUNDS):

        def clusters(blob: tuple, label=label) -> tuple[np.ndarray, np.ndarray]:
            sizes, sums = np.zeros(STATES), np.zeros((width + SYMBOLS, STATES))
            for symbols, row, w, points in _points(blob, frequent):
                own = label(points)
                sizes += np.bincount(own, w, STATES)
                sums[:width] += points.T @ (np.eye(STATES)[own] * w[:, None])
                sums[width:] += np.bincount(symbols * np.int64(STATES) + own[row], w[row], SYMBOLS * STATES).reshape(-1, STATES)
            return sizes, sums

        sizes, sums = _summed(encoded, clusters)
        centres = (sums[:width] / np.maximum(sizes, 1)).T
        label = lambda points, centres=centres: np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)
    return Chain.of_counts(sizes, 1e4 * np.eye(STATES), sums[width:])


def _better_chain(encoded: DataFrame, chain: Chain) -> Chain:
    """One round of Baum-Welch over all training texts."""
    shared = encoded.sparkSession.sparkContext.broadcast(chain)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((SYMBOLS, STATES))]
        for batch in batches:
            for data in batch["data"].to_pylist():
                own = _segments(rounds.unpack(data))
                for k, x in enumerate(shared.value.expect([x for x, _ in own], np.array([w for _, w in own]))):
                    sums[k] += x
        yield pa.record_batch([pa.array(range(-1, -(-SYMBOLS // _BLOCK)), pa.int32()), pa.array([rounds.pack(*sums[:2]), *(rounds.pack(sums[2][a : a + _BLOCK]) for a in range(0, SYMBOLS, _BLOCK))], pa.binary())], names=["block", "data"])

    got = rounds.add_up(encoded.mapInArrow(expect, rounds.SUMS))
    if not got:
        return chain
    return Chain.of_counts(*got[-1], np.concatenate([got[k][0] for k in sorted(got) if k >= 0]))


def score(docs: DataFrame, rounds_of_training: int = ROUNDS) -> DataFrame:
    """One row per row of docs(doc_id, text, ..): base score by word counts, and the model's score."""
    rows, parts = rounds.keyed(docs)
    buckets = rounds.bucket_count(docs, parts)
    answers = stored(rounds.answer(rounds.ask(rows, None, lambda p, _: _Texts(p, buckets).ask_counts()), _count))
    spark = docs.sparkSession
    words = _vocabulary(answers)
    vocabulary = spark.sparkContext.broadcast(words)

    def encode(part: rounds.Part, got: dict) -> pa.Table:
        blobs = [_Texts(part, buckets).encode(got, vocabulary.value)] if part.ids else []
        return pa.table([pa.array([part.part] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], names=["part", "data"])

    encoded = stored(rounds.finish(rows, answers.where("part >= 0"), encode, _ENCODED))
    chain = _first_chain(encoded, words)
    for _ in range(rounds_of_training if words.ends else 0):
        chain = _better_chain(encoded, chain)
    shared, n = spark.sparkContext.broadcast(chain), words.n

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["data"].to_pylist():
                ids, null, held, slot, _, counts, known, base, within, _ = blob = rounds.unpack(data)
                total = shared.value.log10(_sequences(blob)) + within
                yield pa.record_batch(
                    [pa.array(ids, mask=null), pa.array(held), pa.array(counts[slot] + 1), pa.array(known[slot]), pa.array(np.full(len(ids), n)), pa.array(base[slot]), pa.array(total[slot])],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return encoded.mapInArrow(results, SCHEMA)
