"""Exact substring dedup over bytes by suffix arrays of anchored contexts.

Every window of ``WINDOW`` bytes is owned by one anchor in it: the place of the smallest ``GRAM``-byte hash, the leftmost
of equals. Equal windows have equal anchors at equal offsets, so only windows of anchors that occur twice in the corpus
can repeat, and all they depend on is the text around the anchor. Contexts of one anchor meet in one bucket, each
different one once. There a suffix array (``grouping.suffix_array``, linear grouping by Lyndon prefixes) over the
contexts' right sides sorts them; its runs of a common prefix, with the same left sides, are the classes of equal windows.
Every window but the earliest of its class is removed. The array's symbols are blocks of eight bytes, counted from the
anchor, so that the text shrinks by that factor and the order stays that of bytes.

An anchor with more than ``HOT`` occurrences would fill one bucket. Its windows are dealt by a 96-bit hash of their own
bytes instead, each different one once per part; the results are the same by either way.

Rules: null is an empty text; "earlier" is a smaller doc_id (null smallest), then an earlier start; rows that share a
doc_id are ordered by text, those without one by hash of the text, then by text, and a repeated row counts as later. Columns other than doc_id and text are not looked at. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from warcloom.llm import rounds
from warcloom.llm.arrays import _BYTES, blocks, mix, sliding_min, spread_marks, windows
from warcloom.llm.grouping import suffix_array

WINDOW, GRAM = 100, 32
REACH = WINDOW - GRAM  # bytes of a window that may stand before its anchor
HOT = 20_000
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_PLACE = np.uint64((1 << 28) - 1)
_OTHER = 0xA0761D6478BD642F


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row per row of docs(doc_id, text, ..): bytes, removed bytes, removed runs, digest of the kept bytes.

    ``hot``: occurrences beyond which an anchor's windows are dealt by their own hash; it changes no result.
    """
    rows, parts = rounds.keyed(docs)
    buckets = rounds.bucket_count(docs, parts)
    anchors = rounds.answer(rounds.ask(rows, None, lambda p, _: _Texts(p, buckets).ask_anchors()), lambda got: _common(got, hot))
    classes = rounds.answer(rounds.ask(rows, anchors, lambda p, got: _Texts(p, buckets).ask_contexts(got)), _later)
    return rounds.finish(rows, classes, lambda p, got: _Texts(p, buckets).result(got), SCHEMA)


class _Texts:
    """The distinct texts of a part, one after another in ``raw``, and their anchors.

    ``at`` anchors' places, ``low`` and ``high`` the first and last start of the windows they own, ``hashes`` of their grams.
    """

    def __init__(self, part: rounds.Part, buckets: int):
        self.part, self.buckets = part, buckets
        texts = [part.texts[k] for k in part.distinct]
        self.raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.ends = np.cumsum([len(x) + 1 for x in texts], dtype=np.int64) - 1
        self.begins = np.concatenate([[0], self.ends[:-1] + 1]).astype(np.int64)[: len(texts)]
        found = [self._anchors(int(self.begins[a]), self.ends[a:b]) for a, b in blocks(texts)]
        self.at, self.low, self.high, self.hashes = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in range(4))
        self.hashes = self.hashes.astype(np.uint64, copy=False)
        self.sorted, self.back, self.n = np.unique(self.hashes, return_inverse=True, return_counts=True)

    def _anchors(self, base: int, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        raw = self.raw[base : ends[-1] + 1]
        grams = mix(windows(_BYTES[raw], GRAM))
        least = sliding_min((grams & ~_PLACE) | np.arange(len(raw), dtype=np.uint64), REACH + 1)
        starts = np.concatenate([np.arange(a, z - WINDOW + 1) for a, z in zip([0, *(ends[:-1] - base + 1)], ends - base, strict=True)])
        at = (least[starts] & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.diff(at, prepend=-1))
        last = np.concatenate([new[1:], [len(at)]]).astype(np.int64)[: len(new)] - 1
        return at[new] + base, starts[new] + base, starts[last] + base, mix(grams[at[new]], 1)  # mixed again: the smallest of many are not spread evenly

    def ask_anchors(self):
        for b, a, z in rounds.slices(self.sorted, self.buckets):
            yield b, self.part.part, 0, rounds.pack(np.minimum(self.n[a:z], 65535).astype(np.uint16), *rounds.squeeze(self.sorted[a:z]))

    def contexts(self, got: dict) -> None:
        """Contexts of anchors that occur twice, each different one once (``kept``), and windows of hot anchors."""
        twice = rounds.bits(got.get(0, {}), self.sorted, self.buckets)
        hot = rounds.bits(got.get(0, {}), self.sorted, self.buckets, 1)[self.back]
        asked = np.flatnonzero((twice | (self.n > 1))[self.back] & ~hot)
        left, right = self.at[asked] - self.low[asked], self.high[asked] + WINDOW - self.at[asked]
        padded = np.concatenate([np.zeros(REACH, np.uint8), self.raw, np.zeros(WINDOW, np.uint8)])
        around = np.lib.stride_tricks.sliding_window_view(padded, REACH + WINDOW)[self.at[asked]]
        column = np.arange(REACH + WINDOW)
        around = np.where((column >= REACH - left[:, None]) & (column < REACH + right[:, None]), around, 0).astype(np.uint8)
        sides = np.stack([left, right], axis=1).astype(np.uint8)
        first: dict[bytes, int] = {}
        keys = np.concatenate([sides, around], axis=1)
        mine = np.array([first.setdefault(x.tobytes(), k) for k, x in enumerate(keys)], np.int64)
        self.kept = np.flatnonzero(mine == np.arange(len(mine)))
        self.kept = self.kept[np.argsort(self.hashes[asked[self.kept]], kind="stable")]
        self.around, self.sides, self.asked = around[self.kept], sides[self.kept], asked[self.kept]
        self.copies = asked[mine != np.arange(len(mine))]
        self._hot_windows(np.flatnonzero(hot))

    def _hot_windows(self, anchors: np.ndarray) -> None:
        where, hashes, checks = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for a in anchors.tolist():
            low, high = int(self.low[a]), int(self.high[a])
            values = _BYTES[self.raw[low : high + WINDOW]]
            n = high - low + 1
            where.append(np.arange(low, high + 1))
            hashes.append(mix(windows(values, WINDOW)[:n]))
            checks.append((mix(windows(values, WINDOW, _OTHER)[:n]) >> np.uint64(32)).astype(np.uint32))
        where, hashes, checks = map(np.concatenate, (where, hashes, checks))
        order = np.lexsort((where, checks, hashes))
        self.where, hashes, checks = where[order], hashes[order], checks[order]
        self.new = rounds.starts_run(hashes, checks)
        self.wide, self.checks = hashes[self.new], checks[self.new]

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, places, side="right") - 1

    def ask_contexts(self, got: dict):
        self.contexts(got)
        rows = np.array(self.part.distinct, np.int64)
        text = self.text_of(self.at[self.asked])
        ids, seq = self.part.keys[rows[text]], rows[text].astype(np.int32)
        place = self.at[self.asked] - self.begins[text]
        for b, a, z in rounds.slices(self.hashes[self.asked], self.buckets):
            yield b, self.part.part, 1, rounds.pack(self.hashes[self.asked][a:z], self.sides[a:z], self.around[a:z], ids[a:z], seq[a:z], place[a:z])
        ids = self.part.keys[rows[self.text_of(self.where[self.new])]]
        for b, a, z in rounds.slices(self.wide, self.buckets):
            yield b, self.part.part, 2, rounds.pack(self.wide[a:z], self.checks[a:z], ids[a:z])
        for b, data in got.get(0, {}).items():
            yield b, self.part.part, 0, data

    def result(self, got: dict) -> pa.Table:
        self.contexts(got)
        starts = [np.repeat(self.low[self.copies], self.high[self.copies] - self.low[self.copies] + 1)]
        runs = self.high[self.copies] - self.low[self.copies] + 1
        starts[0] = starts[0] + np.arange(len(starts[0])) - np.repeat(np.cumsum(runs) - runs, runs)
        for b, a, z in rounds.slices(self.hashes[self.asked], self.buckets):
            flags = np.unpackbits(rounds.unpack(got[1][b])[0], count=(z - a) * (REACH + 1)).reshape(z - a, REACH + 1)
            entry, offset = np.nonzero(flags)
            starts.append(self.at[self.asked[a:z][entry]] - offset)
        gone = ~self.new
        gone[self.new] = rounds.bits(got.get(2, {}), self.wide, self.buckets)
        starts.append(self.where[gone])
        removed = spread_marks(np.concatenate(starts), WINDOW, len(self.raw))
        part, done, none = self.part, {}, hashlib.sha256(b"").hexdigest()
        for i, k in enumerate(part.distinct):
            mark = removed[self.begins[i] : self.ends[i]]
            runs = int(mark[:1].sum() + (mark[1:] & ~mark[:-1]).sum())
            kept = self.raw[self.begins[i] : self.ends[i]][~mark].tobytes() if runs else part.texts[k]
            done[k] = (len(mark), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest())
        out = []
        for row, first in enumerate(part.first):
            n, *rest = done[first]
            out.append((n, n, 1, none) if row != first and n >= WINDOW else (n, *rest))
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(part.ids, pa.int64()), *map(pa.array, columns, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _common(got: list[tuple[int, int, bytes]], most: int):
    """For each anchor asked about: does another part hold it; has it more than ``most`` occurrences?"""
    asked = [(np.asarray(n, np.int64), rounds.widen(rest)) for n, *rest in (rounds.unpack(data) for _, _, data in got)]
    hashes, counts = (np.concatenate([x[k] for x in asked]) for k in (1, 0))
    order = np.argsort(hashes, kind="stable")
    begin = np.flatnonzero(rounds.starts_run(hashes[order]))
    size = np.diff(np.concatenate([begin, [len(hashes)]]))
    twice, hot = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    twice[order] = np.repeat(size > 1, size)
    hot[order] = np.repeat(np.add.reduceat(counts[order], begin) > most, size)
    yield from rounds.deal((twice, hot), [(part, 0, len(x[1])) for (part, _, _), x in zip(got, asked, strict=True)])


def _later(got: list[tuple[int, int, bytes]]):
    """For each window of each context asked about: does an earlier document or place hold it?"""
    yield from rounds.earliest(got, 2)
    asked = [(part, *rounds.unpack(data)) for part, kind, data in got if kind == 1]
    if asked:
        hashes, sides, around, ids, seq, place = (np.concatenate([x[k] for x in asked]) for k in range(1, 7))
        parts = np.repeat([x[0] for x in asked], [len(x[1]) for x in asked])
        order = np.lexsort((place, seq, parts, ids))
        flags = (np.arange(REACH + 1) <= sides[:, :1]) & (np.arange(REACH + 1) + sides[:, 1:] >= WINDOW)
        first: dict[bytes, int] = {}
        for k in order.tolist():
            first.setdefault(sides[k].tobytes() + around[k].tobytes(), k)
        order = np.fromiter(first.values(), np.int64, len(first))  # the earliest of each different context; others repeat it
        flags[order] = False
        _, back, n = np.unique(hashes[order], return_inverse=True, return_counts=True)
        order = order[n[back] > 1]
        if len(order):
            flags[order] = _repeats(sides[order].astype(np.int64), around[order])
        at = 0
        for x in asked:
            n = len(x[1])
            yield x[0], 1, rounds.pack(np.packbits(flags[at : at + n]))
            at += n
    yield from ((part, 0, data) for part, kind, data in got if kind == 0)


def _repeats(sides: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Of contexts in order: flags of offsets (start before the anchor) whose window an earlier context holds."""
    m = len(sides)
    right_rank, right_same = _sorted_by_suffixes(around[:, REACH:])
    left_rank, left_same = _sorted_by_bytes(np.ascontiguousarray(around[:, REACH - 1 :: -1]))
    flags = np.zeros((m, REACH + 1), bool)
    for offset in range(REACH + 1):
        own = np.flatnonzero((sides[:, 0] >= offset) & (sides[:, 1] >= WINDOW - offset))
        key = np.cumsum(right_same < WINDOW - offset)[right_rank[own]] * m + np.cumsum(left_same < offset)[left_rank[own]]
        later = np.ones(len(own), bool)
        later[np.unique(key, return_index=True)[1]] = False
        flags[own, offset] = later
    return flags


def _sorted_by_suffixes(sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's rank among the suffixes at anchors, and how many bytes the row of a rank shares with the one before."""
    m, width = sides.shape
    blocked = np.zeros((m, -(-width // 8) * 8), np.uint8)
    blocked[:, :width] = sides
    symbols = np.unique(blocked.view(">u8").astype(np.uint64), return_inverse=True)[1].reshape(m, -1) + 1
    text = np.concatenate([symbols, np.zeros((m, 1), symbols.dtype)], axis=1)
    order = np.array(suffix_array(text.ravel().tolist()), np.int64)
    order = order[order % text.shape[1] == 0] // text.shape[1]
    return _ranks(order, sides)


def _sorted_by_bytes(sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _ranks(np.argsort(sides.view(f"V{sides.shape[1]}").ravel(), kind="stable"), sides)


def _ranks(order: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    shared = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 1 << 16):
        part = sides[order[a - 1 : a + (1 << 16)]]
        differ = part[1:] != part[:-1]
        shared[a : a + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), sides.shape[1])
    return rank, shared
