"""Plain, brute-force versions of the operators, and awkward documents."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, part int, bucket string, kind int"


def words(text):
    return WORD.findall((text or "").encode())


def awkward(spark, texts=(), more=()):
    """Documents with nulls, empty and repeated rows, ties, a long text, and columns whose names clash with ours."""
    long_text = " ".join(f"word{k % 977} and{k % 13}" for k in range(6000))
    base = " ".join(f"alpha{k} beta{k % 7}" for k in range(120))
    near = base.replace("alpha60 ", "omega ")
    rows = [(1, base), (2, base), (3, near), (4, ""), (5, None), (6, "   \n\t "), (7, "one"), (8, "one two three"), (9, long_text)]
    rows += [(9, long_text), (10, "x" * 350), (11, "prefix " + base[:400] + " suffix"), (None, base), (None, None), (12, base + " " + base)]
    rows += [(13, "Été à l'école, ça va? 12.5 «naïf» 中文 \U0001f600"), (14, "\x00\x01 \x85 \xa0 end")]
    rows += [(100 + k, text) for k, text in enumerate(texts)]
    rows = [(i, t, "en", "s", None, 7, "b", None) for i, t in rows] + [(*r, "s", None, 7, "b", None) for r in more]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def ordered(rows):
    """Rows as (doc_id, text) in the order that 'earlier' means: rows without id by a signed 64-bit hash, then by text."""
    spot = lambda text: int.from_bytes(xxhash.xxh64((text or "").encode(), seed=42).digest(), "big", signed=True)
    return sorted(rows, key=lambda r: (r[0] is not None, spot(r[1]) if r[0] is None else r[0], (r[1] or "").encode(), r[1] is not None))


def without_repeats(rows, width, cut, join):
    """[(doc_id, units, removed, digest of the kept)] by a table of all windows."""
    seen, out = set(), []
    for doc_id, text in ordered(rows):
        units = cut(text)
        gone = bytearray(len(units))
        for k in range(len(units) - width + 1):
            window = tuple(units[k : k + width])
            if window in seen:
                gone[k : k + width] = b"\1" * width
            seen.add(window)
        kept = [u for u, g in zip(units, gone, strict=True) if not g]
        out.append((doc_id, len(units), sum(gone), hashlib.sha256(join(kept)).hexdigest()))
    return out


def shingles(text, n=5):
    w = words(text)
    return Counter(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else Counter()


def near_classes(rows, least=0.8):
    """{doc_id: smallest doc_id of its class} by comparing all pairs of documents with an id."""
    made = [(i, shingles(t)) for i, t in rows]
    df = Counter(s for _, own in made for s in own)
    weight = {s: math.log((1 + len(made)) / (1 + n)) + 1 for s, n in df.items()}
    ids = sorted({i for i, _ in made if i is not None})
    above = {i: i for i in ids}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for (a, x), (b, y) in itertools.combinations([m for m in made if m[0] is not None and m[1]], 2):
        low = sum(min(x[s], y[s]) * weight[s] for s in x if s in y)
        high = sum(n * weight[s] for s, n in x.items()) + sum(n * weight[s] for s, n in y.items()) - low
        if low >= least * high and top(a) != top(b):
            above[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in ids}


def base_scores(rows, held=lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2):
    """{(doc_id, text): (tokens, known, all training tokens, base score)}"""
    cut = {(i, t): [w.lower() for w in words(t)] + [None] for i, t in rows}
    count = Counter(w for i, t in rows if not held(i) for w in cut[i, t])
    n, v = sum(count.values()), len(count)
    return {k: (len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)) for k, w in cut.items()}
