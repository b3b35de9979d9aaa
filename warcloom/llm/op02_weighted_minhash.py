"""Near-duplicate classes by consistent weighted sampling of TF-IDF shingles, verified by weighted Jaccard similarity.

Shingles are five consecutive words (a shorter text is one shingle). A shingle weighs tf * (log((1 + n) / (1 + df)) + 1),
with df counted over all documents in one round (``rounds``). A text can have a partner only if shingles that occur in
other documents make up ``SIMILAR`` of its weight, since no shared weight comes from others; the rest need no sketch.
Sketches are improved consistent weighted samples: ``BANDS`` bands of ``ROWS`` samples (shingle, quantised weight) each,
taken over the shared shingles. Two texts at similarity 0.8 meet in some band with probability 0.995 or more.

Texts that share a band are not paired with each other. Each is compared with the smallest of its band, first with the
smallest of all its bands, then with those that this has not joined it to. Those that are below ``SIMILAR`` are compared
with each other in blocks of ``BLOCK``, but not if they are in one class already. What that leaves open are links between
a text that fell out and a text of its band that is in the class of the smallest, by whatever links. Where a text fell out,
all of the latter are compared with the smallest; since one minus the similarity is a metric, only those farther from the
smallest than the other text's own distance less 0.2 can be partners, and these are compared. Verified links make classes;
the smallest doc_id of each is kept.

Equal texts are one text throughout. Rules: null, empty and blank texts have no shingles and stay alone; so do rows without
doc_id. Rows that share a doc_id are one document; the first (by text) is its row that is kept. An empty table gives no
rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from warcloom.llm import rounds
from warcloom.llm.arrays import Words, blocks, mix, windows
from warcloom.llm.components import components
from warcloom.llm.stored import free_name, stored

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS, BLOCK = 10, 4, 200
REACH = 1 - SIMILAR
_SHORT = np.uint64((1 << 56) - 1)
_CHUNK = 1 << 17
#: Bytes of text whose words are laid out at once; what is kept of them is smaller.
_TEXT_BYTES = 1 << 21
ROW = "doc_id long, first_row boolean, owner long, key binary, bands array<long>, total double, vector binary"
_random = np.random.default_rng(5)
_GAMMA = _random.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
_LOG_C = np.log(_random.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
_BETA = _random.random(1 << 16, np.float32)


class _Texts:
    """Shingles of the distinct texts of a part: text, hash (56 bits) and count, ordered by text and hash."""

    def __init__(self, part: rounds.Part, buckets: int):
        self.part, self.buckets = part, buckets
        texts = [part.texts[k] for k in part.distinct]
        made = [_shingles(texts[a:z], a) for a, z in blocks(texts, _TEXT_BYTES)] or [_shingles([], 0)]
        self.text, self.hashes, self.tf = (np.concatenate(x) for x in zip(*made, strict=True))
        del made
        slot = {k: i for i, k in enumerate(part.distinct)}
        rows = np.bincount([slot[k] for k in part.first], minlength=len(part.distinct))
        self.sorted, self.back = np.unique(self.hashes, return_inverse=True)
        self.df = np.bincount(self.back, weights=rows[self.text], minlength=len(self.sorted)).astype(np.int64)

    def ask_frequency(self):
        # the letters' order is that of 64-bit hashes, so the 56 bits stand above
        for b, a, z in rounds.slices(self.sorted << np.uint64(8), self.buckets):
            yield b, self.part.part, 0, rounds.pack(rounds.narrow(self.df[a:z]), *rounds.squeeze(self.sorted[a:z], 5))

    def rows(self, got: dict, n: int) -> pa.Table:
        part = self.part
        df = np.zeros(len(self.sorted), np.int64)
        for b, a, z in rounds.slices(self.sorted << np.uint64(8), self.buckets):
            df[a:z] = rounds.unpack(got[0][b])[0]
        weight = (self.tf * (np.log((1 + n) / (1 + df)) + 1)[self.back]).astype(np.float32)
        shared = (df > 1)[self.back]
        texts = len(part.distinct)
        total = np.bincount(self.text, weights=weight, minlength=texts)
        common = np.bincount(self.text[shared], weights=weight[shared], minlength=texts)
        keep = shared & (common >= SIMILAR * total - 1e-6)[self.text]
        text, hashes, weight = self.text[keep], self.hashes[keep], weight[keep]
        begin = np.searchsorted(text, np.arange(texts + 1))
        bands = _sketch(text, hashes, weight, texts)
        out, ids_seen, owners = [], set(), {}
        for row, first in enumerate(part.first):  # the first row of a text that has an id stands for it
            if part.ids[row] is not None:
                owners.setdefault(first, row)
        for row, first in enumerate(part.first):
            doc_id, i = part.ids[row], int(np.searchsorted(part.distinct, first))
            new = doc_id is None or doc_id not in ids_seen
            ids_seen.add(doc_id)
            a, z = begin[i], begin[i + 1]
            grouped = doc_id is not None and total[i] > 0
            own = owners.get(first) == row and grouped and z > a
            key = hashlib.blake2b(part.texts[first], digest_size=16).digest() if grouped else None
            owner = part.ids[owners[first]] if grouped else doc_id
            out.append((doc_id, new, owner, key, bands[i].tolist() if own else None, float(total[i]), rounds.pack(*rounds.squeeze(hashes[a:z], 6), weight[a:z]) if own else None))
        columns = list(zip(*out, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.float64(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "first_row", "owner", "key", "bands", "total", "vector"])


def _shingles(texts: list[bytes], first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, from ``first`` on; hash; count) of the shingles of texts, ordered by text and hash."""
    words = Words(texts)
    place = np.arange(len(words.hashes)) - np.repeat(words.offsets[:-1], words.counts)
    text = np.repeat(np.arange(first, first + len(words.counts), dtype=np.int32), words.counts)
    whole = np.repeat(words.counts, words.counts) - place >= WORDS
    hashes = windows(words.hashes, WORDS)
    for n in range(1, WORDS):  # a text of fewer words is one shingle
        short = np.flatnonzero(words.counts == n)
        at = words.offsets[short]
        hashes[at] = windows(words.hashes, n)[at] + np.uint64(n)
        whole[at] = True
    hashes, text = mix(hashes[whole]) & _SHORT, text[whole]
    order = np.lexsort((hashes, text))
    new = rounds.starts_run(text[order], hashes[order]) if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return text[order][new], hashes[order][new], np.diff(np.append(at, len(order))).astype(np.int32)


def _sketch(text: np.ndarray, hashes: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
    """Band keys of each text. For shingle x of weight S: r, ln c and beta by hash; t = floor(ln S / r + beta); the sample
    is the (x, t) of smallest ln c - r * (t - beta) - r."""
    out = np.zeros((texts, BANDS), np.int64)
    present, begin = np.unique(text, return_index=True)
    cuts = [0]
    for k, at in enumerate(begin):
        if at - begin[cuts[-1]] > _CHUNK:
            cuts.append(k)
    cuts.append(len(present))
    for first, last in zip(cuts, cuts[1:], strict=False):
        if first == last:
            continue
        a, z = begin[first], begin[last] if last < len(begin) else len(text)
        own, h, log_s = begin[first:last] - a, hashes[a:z], np.log(weight[a:z])
        size = np.diff(np.append(own, z - a))
        band = np.zeros(last - first, np.uint64)
        for j in range(BANDS * ROWS):
            g = mix(h, (j + 1) * 0x5851F42D4C957F2D & 0xFFFFFFFFFFFFFFFF)
            r, beta = _GAMMA[g & np.uint64(0xFFFF)], _BETA[(g >> np.uint64(32)) & np.uint64(0xFFFF)]
            t = np.floor(log_s / r + beta)
            score = _LOG_C[(g >> np.uint64(16)) & np.uint64(0xFFFF)] - r * (t - beta) - r
            least = np.flatnonzero(score == np.repeat(np.minimum.reduceat(score, own), size))
            best = least[np.searchsorted(least, own)]
            band = mix(band ^ h[best] ^ mix(t[best].astype(np.int64).view(np.uint64), 3), j)
            if j % ROWS == ROWS - 1:
                out[present[first:last], j // ROWS] = band.view(np.int64)
                band = np.zeros(last - first, np.uint64)
    return out


def similarity(a: bytes, total_a: float, b: bytes, total_b: float) -> float:
    """Weighted Jaccard: sum of the smaller weights over sum of the larger ones."""
    (*ha, wa), (*hb, wb) = rounds.unpack(a), rounds.unpack(b)
    return _overlap((wa, rounds.widen(tuple(ha), 6), total_a), (wb, rounds.widen(tuple(hb), 6), total_b))


def _can_link(total_a: float, total_b: float) -> bool:
    return min(total_a, total_b) >= SIMILAR * max(total_a, total_b) - 1e-6


def _overlap(a: tuple[np.ndarray, np.ndarray, float], b: tuple[np.ndarray, np.ndarray, float]) -> float:
    (wa, ha, total_a), (wb, hb, total_b) = a, b
    at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
    same = hb[at] == ha
    low = float(np.minimum(wa[same], wb[at[same]]).sum(dtype=np.float64))
    return low / (total_a + total_b - low)


def _verified(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """pairs(a, b) with their similarity j."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = {name: batch[name].to_pylist() for name in ("a_vector", "a_total", "b_vector", "b_total")}
            j = [similarity(*row) for row in zip(x["a_vector"], x["a_total"], x["b_vector"], x["b_total"], strict=True)]
            yield pa.record_batch([batch["a"], batch["b"], pa.array(j, pa.float64())], names=["a", "b", "j"])

    side = lambda s: vectors.select(F.col("doc_id").alias(s), F.col("total").alias(f"{s}_total"), F.col("vector").alias(f"{s}_vector"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(work, "a long, b long, j double")


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of docs(doc_id, text, ..): class_id (smallest doc_id of its class) and kept."""
    rows, parts = rounds.keyed(docs)
    buckets = rounds.bucket_count(docs, parts)
    n = docs.count()
    frequency = rounds.answer(rounds.ask(rows, None, lambda p, _: _Texts(p, buckets).ask_frequency()), _frequency)
    made = stored(rounds.finish(rows, frequency, lambda p, got: _Texts(p, buckets).rows(got, n), ROW))
    first = made.where("key IS NOT NULL").groupBy("key").agg(F.min("owner").alias("text_id"))
    member = stored(made.select("doc_id", "first_row", "key").join(first, "key", "left").select("doc_id", "first_row", F.coalesce("text_id", "doc_id").alias("text_id")))
    texts = member.where("doc_id = text_id").select("doc_id").distinct()
    inside = _linked(made.where("vector IS NOT NULL").select("doc_id", "bands", "total", "vector").join(texts, "doc_id", "left_semi"))
    out = member.join(inside.select(F.col("node").alias("text_id"), "component"), "text_id", "left")
    class_id = F.coalesce("component", "text_id")
    kept = F.coalesce(class_id == F.col("doc_id"), F.lit(True)) & F.col("first_row")
    return out.select("doc_id", class_id.alias("class_id"), kept.alias("kept"))


def _linked(vectors: DataFrame) -> DataFrame:
    """(node, component) of the texts that have a verified link; see the head of this module."""
    spark = vectors.sparkSession
    members = stored(_with_lead(vectors.select("doc_id", F.posexplode("bands").alias("band", "key"))))
    others = members.where("doc_id <> lead")
    # the smallest of each text's leads first, then those of its leads that this has not joined it to
    checked = stored(_verified(others.groupBy(F.col("doc_id").alias("a")).agg(F.min("lead").alias("b")), vectors))
    inside = _joined(spark.createDataFrame([], "node long, component long"), checked)
    pairs = _apart(others.select(F.col("doc_id").alias("a"), F.col("lead").alias("b")).distinct(), inside)
    more = stored(_verified(pairs.join(checked, ["a", "b"], "left_anti"), vectors))
    checked, inside = checked.union(more), _joined(inside, more)
    # texts that fell out of a group, with each other
    state = stored(_classes_of(others, inside, "doc_id", "lead"))
    size = state.where("class_a <> class_b").groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    left = state.where("class_a <> class_b").join(size, ["band", "key"])
    left = left.select("band", "key", "doc_id", F.col("class_a").alias("class"), F.expr(f"CAST(ceil(size / {BLOCK}) AS int)").alias("blocks"))
    left = left.withColumn("block", F.expr("CAST(pmod(xxhash64(doc_id), blocks) AS int)")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = left.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    found = left.join(vectors.select("doc_id", "total", "vector"), "doc_id").groupBy("band", "key", "low", "high").applyInArrow(_all_links, "a long, b long, j double")
    inside = _joined(inside, stored(found))
    # and with those members of the lead's class that can be near enough, by whatever links they are in it
    pairs = others.select(F.col("doc_id").alias("a"), F.col("lead").alias("b")).distinct()
    state = _classes_of(pairs, inside, "a", "b").withColumn("out", F.col("class_a") != F.col("class_b")).select("a", "b", "out")
    state = stored(state.join(state.where("out").select("b").distinct(), "b", "left_semi"))
    missing = state.select("a", "b").join(checked, ["a", "b"], "left_anti")
    checked = checked.union(stored(_verified(missing, vectors)))
    near = stored(state.join(checked, ["a", "b"]).select(F.col("b").alias("lead"), F.col("a").alias("doc_id"), "j", "out"))
    far = near.groupBy("lead").agg(F.max(F.when(F.col("out"), F.col("j"))).alias("nearest_out"), F.min(F.when(~F.col("out"), F.col("j"))).alias("farthest_member"))
    near = near.join(far, "lead").where(f"IF(out, j >= farthest_member - {REACH} - 1e-6, j <= nearest_out + {REACH} + 1e-6)").select("lead", "doc_id", "j", "out")
    size = near.groupBy("lead").agg(F.count_if("out").alias("outs"), F.count_if(~F.col("out")).alias("members")).where("outs > 0 AND members > 0")
    size = size.select("lead", *(F.expr(f"CAST(ceil({c} / {BLOCK}) AS int)").alias(c) for c in ("outs", "members")))
    both = near.join(size, "lead").withColumn("mine", F.expr("CAST(pmod(xxhash64(doc_id), IF(out, outs, members)) AS int)"))
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.expr("IF(out, members, outs)") - 1)))
    both = both.select("lead", "doc_id", "j", "out", F.expr("IF(out, mine, other)").alias("low"), F.expr("IF(out, other, mine)").alias("high"))
    found = both.join(vectors.select("doc_id", "total", "vector"), "doc_id").groupBy("lead", "low", "high").applyInArrow(_fringe_links, "a long, b long, j double")
    return _joined(inside, stored(found))


def _fringe_links(rows: pa.Table) -> pa.Table:
    """For each text of one block that fell out of a class: the nearest text of a block of its members, if that is a link.

    A member nearer to the lead than the text's own distance less REACH cannot be one.
    """
    rows = rows.sort_by([("doc_id", "ascending")])
    ids, j, total, out = (rows[c].to_numpy(zero_copy_only=False) for c in ("doc_id", "j", "total", "out"))
    vectors = [(x[-1], rounds.widen(tuple(x[:-1]), 6)) for x in map(rounds.unpack, rows["vector"].to_pylist())]
    members, found = np.flatnonzero(~out), []
    if len(members) and out.any():
        which = np.repeat(np.arange(len(members)), [len(vectors[k][1]) for k in members])
        hashes = np.concatenate([vectors[k][1] for k in members])
        order = np.argsort(hashes, kind="stable")
        hashes, which, weight = hashes[order], which[order], np.concatenate([vectors[k][0] for k in members])[order]
        for k in np.flatnonzero(out):
            own, h = vectors[k]
            a, z = np.searchsorted(hashes, h, side="left"), np.searchsorted(hashes, h, side="right")
            n = z - a
            at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
            low = np.bincount(which[at], weights=np.minimum(weight[at], np.repeat(own, n)), minlength=len(members))
            near = np.where(1 - j[members] >= 1 - j[k] - REACH - 1e-6, low / (total[k] + total[members] - low), 0)
            if near.max() >= SIMILAR:
                found.append((int(ids[k]), int(ids[members[near.argmax()]]), float(near.max())))
    columns = list(zip(*found, strict=True)) or [()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["a", "b", "j"])


def _all_links(rows: pa.Table) -> pa.Table:
    """Links that join the classes of one block of a group, or of two; pairs of one class are not compared."""
    rows = rows.sort_by([("doc_id", "ascending")])
    ids, block, own = (rows[c].to_pylist() for c in ("doc_id", "block", "class"))
    weights = [(x[-1], rounds.widen(tuple(x[:-1]), 6), total) for x, total in zip(map(rounds.unpack, rows["vector"].to_pylist()), rows["total"].to_pylist(), strict=True)]
    two = rows["low"][0].as_py() != rows["high"][0].as_py()
    above = {c: c for c in own}

    def top(c: int) -> int:
        while above[c] != c:
            above[c] = above[above[c]]
            c = above[c]
        return c

    out = []
    for i in range(len(ids)):
        for k in range(i):
            if (two and block[i] == block[k]) or (p := top(own[i])) == (q := top(own[k])):
                continue
            if _can_link(weights[i][-1], weights[k][-1]) and (j := _overlap(weights[i], weights[k])) >= SIMILAR:
                above[max(p, q)] = min(p, q)
                out.append((ids[i], ids[k], j))
    columns = list(zip(*out, strict=True)) or [()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["a", "b", "j"])


def _with_lead(keys: DataFrame) -> DataFrame:
    """Members of each group of two or more, with the smallest."""
    lead = keys.groupBy("band", "key").agg(F.min("doc_id").alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keys.join(lead, ["band", "key"])


def _classes_of(pairs: DataFrame, inside: DataFrame, a: str, b: str) -> DataFrame:
    """pairs with class_a and class_b, a text's own id where it has no link yet."""
    for name, out in ((a, "class_a"), (b, "class_b")):
        own = inside.select(F.col("node").alias(name), F.col("component").alias(out))
        pairs = pairs.join(own, name, "left").withColumn(out, F.coalesce(out, name))
    return pairs


def _apart(pairs: DataFrame, inside: DataFrame) -> DataFrame:
    return _classes_of(pairs, inside, "a", "b").where("class_a <> class_b").select("a", "b")


def _joined(inside: DataFrame, new: DataFrame) -> DataFrame:
    """Classes after the links among newly compared pairs; only classes that a link touches take part."""
    links = new.where(f"j >= {SIMILAR}")
    if links.isEmpty():
        return inside
    merged = components(_classes_of(links, inside, "a", "b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b")))
    nodes = inside.union(merged.select("node", F.col("node").alias("component")).join(inside.select("node"), "node", "left_anti"))
    by_class = merged.select(F.col("node").alias("component"), F.col("component").alias("now"))
    return stored(nodes.join(by_class, "component", "left").select("node", F.coalesce("now", "component").alias("component")))


def _frequency(got: list[tuple[int, int, bytes]]):
    """Total document count of each shingle asked about."""
    asked = [rounds.unpack(data) for _, _, data in got]
    hashes = np.concatenate([rounds.widen(x[1:], 5) for x in asked])
    unique, back = np.unique(hashes, return_inverse=True)
    total = np.bincount(back, weights=np.concatenate([x[0] for x in asked]), minlength=len(unique)).astype(np.int64)[back]
    at = 0
    for (part, kind, _), x in zip(got, asked, strict=True):
        yield part, kind, rounds.pack(rounds.narrow(total[at : at + len(x[0])]))
        at += len(x[0])


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one document of each class; rows and columns as they are. Of rows that share a doc_id the first by text stays.
    Rows without doc_id stay where they are: they take part in no shuffle."""
    kept, row = free_name(docs, "kept_id"), free_name(docs, "row_of_id")
    doc_id = F.col("doc_id").cast("long")
    ids = classes(docs).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(kept)).distinct()
    found = docs.where(doc_id.isNotNull()).join(ids, doc_id == F.col(kept), "left_semi")
    order = Window.partitionBy(doc_id).orderBy(F.col("text").asc_nulls_first())
    found = found.withColumn(row, F.row_number().over(order)).where(F.col(row) == 1).drop(row)
    return found.unionByName(docs.where(doc_id.isNull()))
