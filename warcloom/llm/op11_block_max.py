"""Ranked lexical search by Block-Max MaxScore over an inverted index in shards.

Index. Tasks cut their documents into shards of some ``SHARD_BYTES`` of text and ``SHARD_ROWS`` rows at most. A shard has one row
per term: the number of its documents, the largest impact among them, and its postings (document, frequency) in blocks of
``BLOCK``, each with its last document and its largest impact before it. An impact is what a term gives to a document's score
before it is multiplied by the term's weight; it needs the number of documents and of all terms, which a first pass counts.
A further row per shard holds the documents' ids and lengths. The index is stored once, and any number of items is searched
in it.

Search. Items come in blocks of at most ``ITEM_TERMS`` different terms, which bounds what a task is told: item terms, their weights, and
their global bounds (weight times the largest impact in any shard). An index row whose term no item asks for does not leave
its task; the others meet by shard. Per item, lists are taken by falling bound. While the bounds of the lists left can still
lift an unseen document over the threshold, a list is essential, and all of it is read. The others are only asked about
documents that are candidates already: the block that would hold a candidate is found without reading it, and if the
block's largest impact and the bounds of the lists after it cannot lift the candidate over the threshold, it is rejected
before the block is decompressed. The threshold is the ``TOP``-th best partial score, which never exceeds the final one.

Shards are searched in two rounds. The first takes one shard of ``SEEDS`` by hash and merges their heaps; the ``TOP``-th best
score found there is a threshold that the other shards start from, so that a shard sends only documents that may be in the
result. Thresholds reject only what is below them, never what is equal, so that ties are decided by doc_id as they should.
All shards count: the rounds differ in what is rejected, not in the result.

Rules: null texts have no terms, and a document without terms is not counted. Rows are documents: repeated rows are ranked
each, a null doc_id before all others of the same score. Each row of the benchmark is an item; items without a term, or with none that
occurs, have no result. Empty tables give no rows. Of other columns nothing is looked at. A text longer than a shard is a
shard of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm.rounds import pack, unpack
from warcloom.llm.stored import stored
from warcloom.llm.terms import as_terms, term_hashes
from warcloom.operators.ranking import top_n_per_group

SHARD_BYTES, SHARD_ROWS, BLOCK = 8_000_000, 1 << 15, 128
ITEM_TERMS, SEEDS, TOP = 1 << 15, 16, 50
#: The term of the row with a shard's documents; no row of postings has n = 0.
DOCUMENTS = 0
_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.int64()), ("n", pa.int32()), ("bound", pa.int64()), ("data", pa.binary())])
_INDEX_SQL = "shard long, term long, n int, bound long, data binary"
_HEAD = np.dtype([("last", "<u2"), ("wide", "u1"), ("deep", "u1"), ("most", "<u4")])
_FOUND = "item int, doc_id long, score long"
RANKED = "item_id long, rank int, doc_id long, score long"
#: Constants of the score.
IMPACT, BASE, PER_LENGTH, FLAT, SLOPE = 1_000_000_000, 1000, 20, 50, 50


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, terms as bytes) of the documents of one shard after another."""
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            own = as_terms(text)
            if texts and (size + len(own) > SHARD_BYTES or len(texts) == SHARD_ROWS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(own)
            size += len(own)
    if texts:
        yield ids, texts


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = terms = 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                own = len(as_terms(text).split())
                n, terms = n + (own > 0), terms + own
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([terms], pa.int64())], names=["n", "terms"])

    row = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(work, "n long, terms long").agg(F.sum("n"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


def _norms(lengths: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """m of documents by their number of terms, in integers of any size."""
    own, back = np.unique(lengths, return_inverse=True)
    return np.array([FLAT + (SLOPE * int(x) * size[0]) // max(size[1], 1) for x in own], np.int64)[back]


def _impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return IMPACT * tf // (BASE * tf + PER_LENGTH * norm)


def shard_rows(shard: int, ids: list, texts: list[bytes], size: tuple[int, int]) -> pa.RecordBatch:
    """The index rows of a shard. Documents are numbered by id, nulls first; those without terms are left out."""
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is not None, ids[k] or 0))
    hashes, lengths = term_hashes([texts[k] for k in order])
    some = lengths > 0
    kept = [ids[k] for k, x in zip(order, some, strict=True) if x]
    lengths = lengths[some]
    norm = _norms(lengths, size)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    by_term = np.argsort(hashes, kind="stable")
    hashes, doc = hashes[by_term], doc[by_term]
    new = np.flatnonzero(_changes(hashes) | _changes(doc))
    tf = np.diff(np.append(new, len(hashes)))
    hashes, doc = hashes[new], doc[new]
    impact = _impacts(tf, norm[doc])
    begin = np.flatnonzero(_changes(hashes))
    data, at = _packed(doc, tf, impact, begin)
    n = np.diff(np.append(begin, len(hashes)))
    bound = np.maximum.reduceat(impact, begin) if len(begin) else impact
    known = pack(np.array([x is None for x in kept]), np.array([x or 0 for x in kept], np.int64), lengths)
    blob = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(at), pa.py_buffer(data)]).cast(pa.binary())
    columns = [
        pa.array(np.full(len(n) + 1, shard), pa.int64()),
        pa.array(np.append(hashes[begin].view(np.int64), DOCUMENTS), pa.int64()),
        pa.array(np.append(n, 0), pa.int32()),
        pa.array(np.append(bound, 0), pa.int64()),
        pa.concat_arrays([blob, pa.array([known], pa.binary())]),
    ]
    return pa.record_batch(columns, schema=_INDEX)


def _changes(x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    out[1:] = x[1:] != x[:-1]
    return out


def _packed(doc: np.ndarray, tf: np.ndarray, impact: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all lists and the list's offsets in them. A list is the heads of its blocks, then the blocks: steps between
    documents in one or two bytes, frequencies in none (all are 1), one or eight; the lowest bytes of all first."""
    total = len(doc)
    n = np.diff(np.append(begin, total))
    blocks = -(-n // BLOCK)
    first_block = np.cumsum(blocks) - blocks
    of_list = np.repeat(np.arange(len(n)), blocks)
    start = begin[of_list] + (np.arange(blocks.sum()) - first_block[of_list]) * BLOCK
    if not total:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    step = np.diff(doc, prepend=0)
    step[start] = doc[start]  # a block can be read without the one before
    count = np.diff(np.append(start, total))
    head = np.zeros(len(start), _HEAD)
    head["last"] = doc[np.append(start[1:], total) - 1]
    head["most"] = np.maximum.reduceat(impact, start)
    head["wide"] = 1 + (np.maximum.reduceat(step, start) > 255)
    most = np.maximum.reduceat(tf, start)
    head["deep"] = np.where(most == 1, 0, np.where(most < 256, 1, 8))
    size = count * (head["wide"].astype(np.int64) + head["deep"])
    before = np.cumsum(size) - size
    at = np.append(0, np.cumsum(np.add.reduceat(size, first_block) + blocks * _HEAD.itemsize))
    own = before + (first_block + blocks)[of_list] * _HEAD.itemsize
    out = np.zeros(int(at[-1]), np.uint8)
    heads = at[of_list] + (np.arange(len(start)) - first_block[of_list]) * _HEAD.itemsize
    out[heads[:, None] + np.arange(_HEAD.itemsize)] = head.view(np.uint8).reshape(-1, _HEAD.itemsize)
    block = np.repeat(np.arange(len(start)), count)
    place = own[block] + np.arange(total) - start[block]
    width, depth, many = head["wide"][block], head["deep"][block], count[block]
    out[place] = step & 255
    two = width == 2
    out[(place + many)[two]] = step[two] >> 8
    for k in range(8):
        some = depth > k
        out[(place + (width.astype(np.int64) + k) * many)[some]] = tf[some] >> (8 * k) & 255
    return out, at


def build_index(docs: DataFrame, size: tuple[int, int]) -> DataFrame:
    """The index of docs(doc_id, text, ..) as rows (shard, term, n, bound, data), stored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(_shards(batches)):
            yield shard_rows((part << 24) + k, ids, texts, size)

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, _INDEX_SQL))


class Postings:
    """A term's list in a shard. Blocks are decompressed when they are asked for, once."""

    def __init__(self, n: int, data: bytes, norm: np.ndarray):
        self.n, self.norm, self.data = n, norm, data
        blocks = -(-n // BLOCK)
        self.head = np.frombuffer(data, _HEAD, blocks)
        self.last, self.most = self.head["last"].astype(np.int64), self.head["most"].astype(np.int64)
        count = np.full(blocks, BLOCK)
        count[-1] = n - BLOCK * (blocks - 1)
        size = count * (self.head["wide"].astype(np.int64) + self.head["deep"])
        self.count, self.at = count, blocks * _HEAD.itemsize + np.cumsum(size) - size
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a block."""
        if k not in self.read:
            n, at, (wide, deep) = int(self.count[k]), int(self.at[k]), self.head[["wide", "deep"]][k]
            planes = np.frombuffer(self.data, np.uint8, n * (int(wide) + int(deep)), at).reshape(-1, n).astype(np.int64)
            doc = np.cumsum(planes[0] + (planes[1] << 8) if wide == 2 else planes[0])
            tf = sum(planes[wide + j] << (8 * j) for j in range(deep)) if deep else np.ones(n, np.int64)
            self.read[k] = doc, _impacts(tf, self.norm[doc])
        return self.read[k]

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        made = [self.block(k) for k in range(len(self.count))]
        return made[0] if len(made) == 1 else tuple(map(np.concatenate, zip(*made, strict=True)))


def search_shard(lists: list[tuple[Postings, int, int]], documents: int, top: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a shard that may be among the ``top``: (postings, weight, bound) by falling bound."""
    score = np.zeros(documents, np.int64)
    left = np.append(np.cumsum([bound for *_, bound in lists][::-1])[::-1], 0)
    threshold = max(threshold, 1)
    k = 0
    while k < len(lists) and left[k] >= threshold:  # essential: an unseen document can still be in the result
        postings, weight, _ = lists[k]
        doc, impact = postings.whole()
        score[doc] += weight * impact
        k += 1
        if left[k] >= threshold:
            threshold = max(threshold, _best(score, top))
    threshold = max(threshold, _best(score, top))
    candidate = np.flatnonzero(score + left[k] >= threshold)
    candidate = candidate[score[candidate] > 0] if k else candidate[:0]
    own = score[candidate]
    for j in range(k, len(lists)):
        if not len(candidate):
            break
        postings, weight, _ = lists[j]
        at = np.searchsorted(postings.last, candidate)
        there = at < len(postings.last)
        most = np.zeros(len(candidate), np.int64)
        most[there] = np.minimum(weight * postings.most[at[there]], left[j] - left[j + 1])
        keep = own + most + left[j + 1] >= threshold
        if not keep.all():
            candidate, own, at, there = candidate[keep], own[keep], at[keep], there[keep]
        for b in np.unique(at[there]).tolist():
            doc, impact = postings.block(b)
            mine = np.flatnonzero(at == b)
            place = np.minimum(np.searchsorted(doc, candidate[mine]), len(doc) - 1)
            hit = doc[place] == candidate[mine]
            own[mine[hit]] += weight * impact[place[hit]]
        threshold = max(threshold, _best(own, top))
    keep = own >= threshold
    candidate, own = candidate[keep], own[keep]
    best = np.lexsort((candidate, -own))[:top]
    return candidate[best], own[best]


def _best(scores: np.ndarray, top: int) -> int:
    """The ``top``-th largest, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - top)[len(scores) - top]) if len(scores) >= top else 0


@dataclass(frozen=True)
class Items:
    """A block of items: for each its terms as places in ``terms`` (sorted), by falling bound."""

    terms: np.ndarray
    weight: np.ndarray
    bound: np.ndarray
    wanted: list[np.ndarray]


def _search(found: DataFrame, items: Items, size: tuple[int, int], top: int, threshold: np.ndarray) -> DataFrame:
    """(item, doc_id, score) that the shards' heaps hold, from the index rows of the items' terms."""

    def work(rows: pa.Table) -> pa.Table:
        term, n, data = rows["term"].to_numpy().view(np.uint64), rows["n"].to_numpy(), rows["data"].to_pylist()
        about = int(np.flatnonzero(n == 0)[0])
        null, ids, lengths = unpack(data[about])
        norm = _norms(lengths, size)
        here = {int(np.searchsorted(items.terms, t)): Postings(int(c), d, norm) for t, c, d in zip(term, n, data, strict=True) if c}
        out: list[list] = [[], [], []]
        for item, wanted in enumerate(items.wanted):
            lists = [(here[t], int(items.weight[t]), int(items.bound[t])) for t in wanted.tolist() if t in here]
            if lists:
                doc, score = search_shard(lists, len(lengths), top, int(threshold[item]))
                for column, x in zip(out, ([item] * len(doc), [None if null[d] else int(ids[d]) for d in doc], score.tolist()), strict=True):
                    column += x
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["item", "doc_id", "score"])

    return found.groupBy("shard").applyInArrow(work, _FOUND)


def _merged(found: DataFrame, top: int) -> DataFrame:
    """The heaps of all shards made one per item."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    return top_n_per_group(found, ["item"], order, top, spread=["doc_id", "score"])


def _item_blocks(benchmark: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(item ids, their different terms) for blocks of items with at most ITEM_TERMS terms; a longer item stands alone."""
    ids: list = []
    terms: list[np.ndarray] = []
    size = 0
    given = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in given.orderBy("item_id", "text").toLocalIterator():
        own = np.unique(term_hashes([as_terms(row.text)])[0])
        if not len(own):
            continue
        if ids and size + len(own) > ITEM_TERMS:
            yield ids, terms
            ids, terms, size = [], [], 0
        ids.append(row.item_id)
        terms.append(own)
        size += len(own)
    if ids:
        yield ids, terms


def search(index: DataFrame, size: tuple[int, int], benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents for each row of benchmark(item_id, text, ..), ranked from 1."""
    out = index.sparkSession.createDataFrame([], RANKED)
    for ids, terms in _item_blocks(benchmark):
        out = out.unionByName(_search_block(index, size, ids, terms, top))
    return out


def _search_block(index: DataFrame, size: tuple[int, int], ids: list, terms: list[np.ndarray], top: int) -> DataFrame:
    spark = index.sparkSession
    every = np.unique(np.concatenate(terms))
    asked = spark.createDataFrame(pa.table([pa.array(every.view(np.int64))], names=["term"]))
    found = index.where("n > 0").join(asked, "term", "left_semi").unionByName(index.where("n = 0"))
    df, bound = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
    for row in found.where("n > 0").groupBy("term").agg(F.sum("n").alias("df"), F.max("bound").alias("bound")).collect():
        at = np.searchsorted(every, np.int64(row.term).view(np.uint64))
        df[at], bound[at] = row.df, row.bound
    weight = np.floor(1000 * np.log((2 * size[0] + 2) / (2 * df + 1))).astype(np.int64)
    limit = weight * bound
    wanted = [np.searchsorted(every, x) for x in terms]
    wanted = [x[np.argsort(-limit[x], kind="stable")] for x in wanted]
    items = Items(every, weight, limit, wanted)
    threshold = np.zeros(len(ids), np.int64)
    seed = F.expr(f"pmod(xxhash64(shard), {SEEDS}) = 0")
    first = stored(_merged(_search(found.where(seed), items, size, top, threshold), top))
    for row in first.where(F.col("rank") == top).collect():
        threshold[row.item] = row.score
    rest = _search(found.where(~seed), items, size, top, threshold)
    best = _merged(first.drop("rank").unionByName(rest), top)
    named = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long")
    return best.join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def rank_documents(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """Index docs(doc_id, text, ..) and search it for every row of benchmark(item_id, text, ..)."""
    size = corpus_size(docs)
    return search(build_index(docs, size), size, benchmark, top)
