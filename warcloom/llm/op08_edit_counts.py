"""Token counts that follow edits.

A document's tokens are counted pre-token by pre-token (the byte-level vocabulary never merges across them). The counts are
the leaves of a segment tree: blocks of ``LEAVES`` leaves under nodes that hold the sums of their subtrees, tokens and leaves.
An edit replaces a stretch of the text. The pre-tokens it touches, and the one before it, whose match may look ahead, are
found again from there on; scanning stops at the first boundary behind the edit that was one before, as the scanner remembers
nothing, so all later pre-tokens stay. Only the new ones are encoded, and only the sums above the touched blocks change.

Edits of a document are applied in one sweep from the last to the first, over a list of stretches of pre-tokens: those
left of the sweep are the original ones, those right of it lie as slices on a stack. Edits that touch neighbouring
pre-tokens are applied together. The text is never copied, so the time is linear in the text and the edits (with the
logarithm of the number of blocks for each), for very long texts, too.

Edits are (start, end, replacement) in code points of the text before any edit, applied from the last to the first; a span
that overlaps one already taken is skipped, and spans are clipped to the text. ``count_edits`` takes them from a column;
``redactions`` makes them: the scanned secrets, long digit runs and runs of three or more signs.

Rules: null is an empty text with no tokens. Rows are independent, so repeated rows give repeated rows. An empty table
gives no rows. Columns other than doc_id, text and the edits are not looked at.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm.op05_secrets import base_spans

#: Bytes of known pre-tokens that a worker keeps, each with what its entry takes.
CACHED_BYTES, ENTRY_BYTES = 40_000_000, 160
LEAVES, NEIGHBOURS, AHEAD = 64, 8, 4
#: What the pattern can look at behind the end of a match, and from the start of a contraction.
REACH = 3
MARK = "[redacted]"
SCHEMA = "doc_id long, n_edits long, tokens_before long, tokens_after long, pretokens_after long, pretokens_encoded long"
_DIGITS = regex.compile(r"(?<!\d)\d{13,19}(?!\d)")
_SIGNS = regex.compile(r"([#&%$*=~_])\1{2,}")
_made: dict[str, PieceCounter] = {}


class PieceCounter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}
        self.room = CACHED_BYTES

    @classmethod
    def of(cls, path: str, pattern: str) -> PieceCounter:
        if path not in _made:
            _made[path] = cls(path, pattern)
        return _made[path]

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            size = ENTRY_BYTES + 4 * len(piece)
            if size <= self.room:
                self.known[piece] = n
                self.room -= size
        return n

    def counts(self, pieces: list[str]) -> list[int]:
        found = list(map(self.known.get, pieces))
        if None in found:
            found = [self.count(x) if n is None else n for x, n in zip(pieces, found, strict=True)]
        return found


class SumTree:
    """A segment tree over blocks of leaves. ``sums`` and ``sizes`` are heaps: node k has the children 2k and 2k + 1, and the
    blocks are the last ``width`` nodes; a node holds the tokens, and the number of leaves, below it."""

    def __init__(self, leaves: list[int]):
        blocks = max(-(-len(leaves) // LEAVES), 1)
        self.width = 1 << (blocks - 1).bit_length()
        self.sums = self._heap(np.add.reduceat(np.array(leaves, np.int64), np.arange(0, len(leaves), LEAVES)) if leaves else [])
        sizes = np.minimum(LEAVES, len(leaves) - np.arange(blocks) * LEAVES) if leaves else []
        self.sizes = self._heap(sizes)

    def _heap(self, of_blocks) -> array:
        level = np.zeros(self.width, np.int64)
        level[: len(of_blocks)] = of_blocks
        levels = [level]
        while len(level) > 1:
            level = level[0::2] + level[1::2]
            levels.append(level)
        return array("q", np.concatenate([np.zeros(1, np.int64), *levels[::-1]]).tobytes())

    def change(self, block: int, tokens: int, leaves: int) -> None:
        """Add to a block, and to the sums above it."""
        at = block + self.width
        while at:
            self.sums[at] += tokens
            self.sizes[at] += leaves
            at //= 2

    @property
    def total(self) -> int:
        return self.sums[1]

    def before_block_of(self, leaf: int) -> tuple[int, int]:
        """(tokens, leaves) of the blocks before the one that holds a leaf, from whole subtrees."""
        at, tokens, leaves = 1, 0, 0
        while at < self.width:
            at *= 2
            if leaf - leaves >= self.sizes[at]:
                tokens, leaves, at = tokens + self.sums[at], leaves + self.sizes[at], at + 1
        return tokens, leaves


class Leaves:
    """The tree as it is after all edits, with its leaves."""

    def __init__(self, tree: SumTree, counts: list[int]):
        self.tree, self.levels, self.total = tree, [counts], tree.total

    def before(self, leaf: int) -> int:
        """Sum of the leaves before one: whole subtrees, and leaves of one block."""
        tokens, first = self.tree.before_block_of(leaf)
        return tokens + sum(self.levels[0][first:leaf])


class CountedText:
    """A text, its pre-tokens and the tree of their token counts."""

    def __init__(self, text: str, counter: PieceCounter):
        self.counter, self.encoded, self.original = counter, 0, text
        self.given = counter.pattern.findall(text)
        self.given_starts = array("q", accumulate(map(len, self.given), initial=0))
        if self.given_starts.pop() != len(text):  # the pattern leaves something out
            raise ValueError("pre-tokens do not cover the text")
        self.given_counts = counter.counts(self.given)
        self.sums = SumTree(self.given_counts)
        # stretches of pre-tokens right of the sweep, the leftmost last: [pieces, counts, low, high, block or -1 for given ones]
        self.done: list[list] = []
        self.left = len(self.given)

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply edits that do not overlap, given from the last to the first."""
        k = 0
        while k < len(edits):
            low, high = self._touched(edits[k])
            own = [edits[k]]
            k += 1
            while k < len(edits) and (near := self._touched(edits[k]))[1] + NEIGHBOURS >= low:
                low = min(low, near[0])
                own.append(edits[k])
                k += 1
            self._replace(low, high, own[::-1])

    def _touched(self, edit: tuple[int, int, str]) -> tuple[int, int]:
        """Pre-tokens that an edit touches, with the one before, whose match looked ahead to it."""
        start, end, _ = edit
        return max(bisect_right(self.given_starts, max(start - 1, 0)) - 2, 0), bisect_left(self.given_starts, end)

    def _replace(self, low: int, high: int, edits: list[tuple[int, int, str]]) -> None:
        """Find again the pre-tokens from low on, edits lying before the given pre-token high."""
        high = min(high, self.left)
        if high < self.left:
            self.done.append([self.given, self.given_counts, high, self.left, -1])
        self.left = low
        text, at = self.original, self.given_starts[low] if self.given else 0
        parts = []
        for start, end, replacement in edits:
            parts += [text[at:start], replacement]
            at = end
        stop = self.given_starts[high] if high < len(self.given) else len(text)
        changed = "".join([*parts, text[at:stop]])
        settled = len(changed) - (stop - at)  # behind the last edit
        window, ahead, old, more = changed, AHEAD, {len(changed): 0}, 0
        while True:
            for piece in self._following(more, ahead):
                window += piece
                more += 1
                old[len(window)] = more
            whole = more < ahead  # the window ends with the text
            pieces = self.counter.pattern.findall(window)
            place = 0
            for k, piece in enumerate([*pieces, ""]):
                if place >= settled and place in old and (whole or (place + REACH <= len(window) and k < len(pieces))):
                    return self._put(low, high, pieces[:k], old[place])
                place += len(piece)
            ahead *= 4

    def _following(self, low: int, high: int) -> Iterator[str]:
        """Pre-tokens right of the sweep, from the low-th to before the high-th."""
        for pieces, _, a, z, _ in reversed(self.done):
            if high <= 0:
                return
            yield from pieces[a + max(low, 0) : min(a + high, z)]
            low, high = low - (z - a), high - (z - a)

    def _put(self, low: int, high: int, pieces: list[str], used: int) -> None:
        """Put pieces in the place of the given ones from low to high and of the next ``used`` right of them."""
        self._taken(self.given_counts, low, high, -1)
        while used:
            top = self.done[-1]
            n = min(used, top[3] - top[2])
            self._taken(top[1], top[2], top[2] + n, top[4])
            top[2] += n
            used -= n
            if top[2] == top[3]:
                self.done.pop()
        counts = self.counter.counts(pieces)
        block = min(low // LEAVES, self.sums.width - 1)
        self.sums.change(block, sum(counts), len(counts))
        if pieces:
            self.done.append([pieces, counts, 0, len(pieces), block])
        self.encoded += len(pieces)

    def _taken(self, counts: list[int], low: int, high: int, block: int) -> None:
        """Take leaves out of the sums, those of each block at once."""
        while low < high:
            end = high if block >= 0 else min(high, (low // LEAVES + 1) * LEAVES)
            self.sums.change(low // LEAVES if block < 0 else block, -sum(counts[low:end]), low - end)
            low = end

    def _stretches(self, which: int) -> list:
        out = (self.given, self.given_counts)[which][: self.left]
        for stretch in reversed(self.done):
            out += stretch[which][stretch[2] : stretch[3]]
        return out

    @property
    def size(self) -> int:
        return self.sums.sizes[1]

    @cached_property
    def pieces(self) -> list[str]:
        return self._stretches(0)

    @property
    def text(self) -> str:
        return "".join(self.pieces)

    @property
    def starts(self) -> array:
        return array("q", accumulate(map(len, self.pieces[:-1]), initial=0)) if self.pieces else array("q")

    @property
    def tree(self) -> Leaves:
        return Leaves(self.sums, self._stretches(1))


def edited(text: str, edits: list[tuple[int, int, str]], counter: PieceCounter) -> tuple[int, int, int, CountedText]:
    """(edits applied, tokens before, tokens after, the counted text)."""
    counted = CountedText(text, counter)
    before, taken, limit = counted.sums.total, [], len(text)
    for start, end, replacement in sorted(edits, key=lambda e: (-e[0], -e[1])):
        start, end = max(start, 0), min(end, len(text))
        if start <= end <= limit:
            taken.append((start, end, replacement))
            limit = start
    counted.apply(taken)
    return len(taken), before, counted.sums.total, counted


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that a cleaning pass makes: secrets and long numbers are marked, runs of signs go."""
    spans = [(a, z, MARK) for a, _, z in base_spans(text)]
    spans += [(*m.span(), MARK) for m in _DIGITS.finditer(text)]
    return spans + [(*m.span(), "") for m in _SIGNS.finditer(text)]


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def count_edits(docs: DataFrame, edits: str | None = None, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Counts before and after the edits in a column (array of struct(start, end, replacement)), or after ``redactions``."""
    path, pattern = vocabulary or default_vocabulary()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter.of(path, pattern)
        for batch in batches:
            given = batch["edits"].to_pylist() if edits else [None] * batch.num_rows
            rows = []
            for doc_id, text, own in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), given, strict=True):
                wanted = [tuple(e.values()) for e in own or () if e and None not in e.values()] if edits else redactions(text or "")
                done, before, after, counted = edited(text or "", wanted, counter)
                rows.append((doc_id, done, before, after, counted.size, counted.encoded))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "n_edits", "tokens_before", "tokens_after", "pretokens_after", "pretokens_encoded"])

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *([F.col(edits).alias("edits")] if edits else [])]
    return docs.select(*columns).mapInArrow(work, SCHEMA)
