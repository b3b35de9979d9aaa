"""Exact substring dedup over words by difference-cover anchors.

Any two equal windows of ``WINDOW`` words share an aligned anchor: of 13 consecutive offsets at least one lies, in both
documents, at a place whose remainder modulo 13 is in the difference cover {0, 1, 3, 9} (every difference modulo 13 is a
difference of two of its members). So only the eight-word strings at those places, 4 of 13, are hashed and compared
across the corpus. A string that occurs twice is extended to the windows around it, and the windows' own hashes (96 bits)
decide: every occurrence but the first goes.

Rules: null is an empty text; windows stay within a document; "earlier" is a smaller doc_id (null smallest), then an
earlier start. Rows that share a doc_id are ordered by text, those without one by hash of the
text, then by text, and a repeated row counts as later. Columns other than
doc_id and text are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from warcloom.llm import rounds
from warcloom.llm.arrays import Words, mix, spread_marks, windows

WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
SCHEMA = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string"
_OTHER = 0xA0761D6478BD642F


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text, ..): words, removed words, removed runs, digest of the kept words."""
    rows, parts = rounds.keyed(docs)
    buckets = rounds.bucket_count(docs, parts)
    anchors = rounds.answer(rounds.ask(rows, None, lambda p, _: _Texts(p, buckets).ask_anchors()), rounds.seen_elsewhere)
    firsts = rounds.answer(rounds.ask(rows, anchors, lambda p, got: _Texts(p, buckets).ask_windows(got)), _earliest)
    return rounds.finish(rows, firsts, lambda p, got: _Texts(p, buckets).result(got), SCHEMA)


class _Texts:
    """The distinct texts of a part. Each round computes the same arrays again, so answers come as bits in their order."""

    def __init__(self, part: rounds.Part, buckets: int):
        self.part, self.buckets = part, buckets
        self.words = Words([part.texts[k] for k in part.distinct])
        w = self.words
        self.place = np.arange(len(w.hashes)) - np.repeat(w.offsets[:-1], w.counts)
        self.left = np.repeat(w.counts, w.counts) - self.place
        covered = np.zeros(PERIOD, bool)
        covered[list(COVER)] = True
        self.at = np.flatnonzero(covered[self.place % PERIOD] & (self.left >= ANCHOR))
        self.anchors = mix(windows(w.hashes, ANCHOR)[self.at])
        self.sorted, self.back, self.n = np.unique(self.anchors, return_inverse=True, return_counts=True)

    def ask_anchors(self):
        for b, a, z in rounds.slices(self.sorted, self.buckets):
            yield b, self.part.part, 0, rounds.pack(*rounds.squeeze(self.sorted[a:z]))

    def candidates(self, got: dict) -> None:
        """Windows that hold an anchor seen twice, sorted by hash; ``new`` marks the first here of each."""
        twice = (rounds.bits(got.get(0, {}), self.sorted, self.buckets) | (self.n > 1))[self.back]
        at = self.at[twice]
        low = at - np.minimum(self.place[at], WINDOW - ANCHOR)
        near = spread_marks(low, at - low + 1, len(self.place))
        self.where = np.flatnonzero(near & (self.left >= WINDOW))
        hashes = mix(windows(self.words.hashes, WINDOW)[self.where])
        checks = (mix(windows(self.words.hashes, WINDOW, _OTHER)[self.where]) >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((checks, hashes))
        self.where, hashes, checks = self.where[order], hashes[order], checks[order]
        self.new = rounds.starts_run(hashes, checks)
        self.hashes, self.checks = hashes[self.new], checks[self.new]

    def ask_windows(self, got: dict):
        self.candidates(got)
        text = np.searchsorted(self.words.offsets, self.where[self.new], side="right") - 1
        ids = self.part.keys[np.array(self.part.distinct, np.int64)[text]]
        for b, a, z in rounds.slices(self.hashes, self.buckets):
            yield b, self.part.part, 1, rounds.pack(self.hashes[a:z], self.checks[a:z], ids[a:z])
        for b, data in got.get(0, {}).items():
            yield b, self.part.part, 0, data

    def result(self, got: dict) -> pa.Table:
        self.candidates(got)
        gone = ~self.new
        gone[self.new] = rounds.bits(got.get(1, {}), self.hashes, self.buckets)
        removed = spread_marks(self.where[gone], WINDOW, len(self.place))
        part, done = self.part, {}
        for i, k in enumerate(part.distinct):
            a, z = self.words.offsets[i], self.words.offsets[i + 1]
            mark, words = removed[a:z], part.texts[k].split()
            runs = int(mark[:1].sum() + (mark[1:] & ~mark[:-1]).sum())
            kept = compress(words, (~mark).tolist()) if runs else words
            done[k] = (len(words), int(mark.sum()), runs, hashlib.sha256(b" ".join(kept)).hexdigest())
        out = []
        for row, first in enumerate(part.first):
            n, *rest = done[first]
            out.append((n, n, 1, hashlib.sha256(b"").hexdigest()) if row != first and n >= WINDOW else (n, *rest))
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(part.ids, pa.int64()), *map(pa.array, columns, kinds)], names=["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256"])


def _earliest(got: list[tuple[int, int, bytes]]):
    """For each window asked about: does an earlier document hold it? Answers of the round before go along."""
    yield from rounds.earliest(got, 1)
    yield from ((part, 0, data) for part, kind, data in got if kind == 0)
