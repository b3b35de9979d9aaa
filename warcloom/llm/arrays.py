"""Hashes of words, word windows and byte windows over whole texts, as numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: The C library's call, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_BASE, _WORD = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Powers that a worker keeps; longer texts, which are few, make their own.
KEPT_POWERS = 1 << 21
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Every input bit changes every output bit (a 64-bit finaliser)."""
    x = x + np.uint64(seed)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64), 0x1234567)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, or more of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if len(have) <= KEPT_POWERS:
            _powers[base] = have
    return have


def give_back() -> None:
    """Free memory of this worker process goes back to the system, as workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def blocks(texts: list[bytes], most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about ``most`` bytes together; a longer text stands alone."""
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, k
            start, size = k, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """Words (runs of bytes other than ASCII white space) of several texts.

    ``hashes`` all words in order; ``counts`` by text; ``offsets`` the first word of each text, and the total at the end;
    ``tails``, if asked for, the last three bytes of each word as a number.
    """

    def __init__(self, texts: list[bytes], with_tails: bool = False):
        hashes, counts, tails = [], [], []
        for a, b in blocks(texts):
            data = b"\n".join(texts[a:b]) + b"\n"
            raw = np.frombuffer(data, np.uint8)
            edge = np.flatnonzero(np.diff(_SPACE[raw].view(np.int8), prepend=1))
            s, e = edge[0::2], edge[1::2]
            up = powers(_BASE, len(raw))
            down = powers(pow(_BASE, -1, 1 << 64), len(raw))
            total = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(_BYTES[raw] * up[: len(raw)], out=total[1:])
            hashes.append(mix((total[e] - total[s]) * down[s]))
            text_ends = np.cumsum([len(x) + 1 for x in texts[a:b]])
            counts.append(np.diff(np.searchsorted(s, text_ends), prepend=0))
            if with_tails:
                tail = raw[e - 1].astype(np.uint32)
                for k in (2, 3):
                    tail = tail * np.uint32(256) + np.where(e - s >= k, raw[np.maximum(e - k, 0)], 0).astype(np.uint32)
                tails.append(tail)
        join = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, kind)
        self.hashes = join(hashes, np.uint64)
        self.tails = join(tails, np.uint32)
        self.counts = join(counts, np.int64).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)


def windows(values: np.ndarray, width: int, base: int = _WORD) -> np.ndarray:
    """Hash of values[i : i + width] for each i, by doubling; the last ``width - 1`` have no meaning."""
    n = len(values)

    def ahead(x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        out[: max(n - k, 0)] = x[k:]
        out *= np.uint64(pow(base, k, 1 << 64))
        return out

    done, have, cur, step = np.zeros(n, np.uint64), 0, values, 1
    while True:
        if width & step:
            done += ahead(cur, have)
            have += step
        if step * 2 > width:
            return done
        cur = cur + ahead(cur, step)
        step *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of values[i : i + width]; the last ``width - 1`` look at what there is."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        if step >= len(out):
            break
        out[:-step] = np.minimum(out[:-step], out[step:])
        have += step
    return out


def spread_marks(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in [s, s + width) for some s of starts; s + width <= n."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
    return np.cumsum(steps[:n]) > 0
