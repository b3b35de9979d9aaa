"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1-, 2- and 3-grams of code points of the lower-cased text with white space as one blank, hashed to
``2**BITS`` columns. A feature's value is its share of the text's n-grams (tf) times log((1 + n) / (1 + df)) + 1, with df
counted over all training documents. Weights are learned by follow-the-regularised-leader with L1 and L2 penalties
(one learning rate per weight, sparse by L1), on a sample of labelled documents; all else covers all documents. The sample
holds each text once and is picked by the hash of the text: an equal share of every language, about ``SAMPLE`` in all, but
of a language with few documents as large a share as gives about ``FLOOR``. So the driver gets some ``SAMPLE`` plus
``FLOOR`` per language, whatever the size of the table and however often a text is repeated. The last fifth of the sample, which training does not see, calibrates one
temperature by which the scores are divided.

Predictions use text alone. ``und`` with score 0 if the text is null or has no letter, or if nothing was learned.

Rules: documents with null text or null label teach nothing. Repeated rows are predicted each. Of languages with equal
scores the first by name is taken. A very long text counts whole, and is laid out alone. An empty table gives no
rows. Columns other than doc_id, text and lang are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm.arrays import give_back

BITS = 16
SAMPLE, FLOOR = 3000, 100
ALPHA, BETA, L1, L2, EPOCHS, BATCH = 10.0, 1.0, 1e-3, 1e-3, 6, 32
HELD = "crc32(cast(doc_id AS string)) % 3 = 1"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_SPACES = re.compile(r"\s+")
_BLOCK = 1 << 20


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts in order, and how many each has."""
    clean = [_SPACES.sub(" ", f" {x.lower()} ") for x in texts]
    points = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(x) for x in clean], np.int64)
    shift = np.uint32(32 - BITS)
    one = points * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (points[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B) if len(points) > 1 else one[:0]
    three = (two[:-1] ^ (points[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35) if len(points) > 2 else one[:0]
    out = np.empty((len(points), 3), np.int32)
    for k, x in enumerate((one, two, three)):
        out[: len(x), k] = x >> shift
        out[len(x) :, k] = 0
    # n-grams that would run into the next text count as column 0
    ends = np.cumsum(size)
    out[ends - 1, 1] = 0
    out[ends - 1, 2] = 0
    out[np.maximum(ends - 2, 0), 2] = 0
    return out.ravel(), size * 3


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # column x language, idf and temperature within
    bias: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [(UNKNOWN, 0.0)] * len(texts)
        known = [k for k, x in enumerate(texts) if x and self.langs and _LETTER.search(x)]
        for part in _by_size(known, texts):
            columns, size = features([texts[k] for k in part])
            begin = np.cumsum(size) - size
            z = np.stack([np.add.reduceat(self.weights[:, j][columns], begin) for j in range(len(self.langs))], axis=1)
            p = _softmax(z / size[:, None] + self.bias)
            for k, row in zip(part, p, strict=True):
                out[k] = (self.langs[int(row.argmax())], float(row.max()))
        return out


def _by_size(which: list[int], texts: list) -> Iterator[list[int]]:
    part, size = [], 0
    for k in which:
        if part and size + len(texts[k]) > _BLOCK:
            yield part
            part, size = [], 0
        part.append(k)
        size += len(texts[k])
    if part:
        yield part


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def document_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """df of every column over all rows of docs(text), and how many rows there are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            texts = batch["text"].to_pylist()
            n += len(texts)
            for part in _by_size(range(len(texts)), texts):
                columns, size = features([texts[k] for k in part])
                for a, z in zip(np.cumsum(size) - size, np.cumsum(size), strict=True):
                    seen = np.zeros(1 << BITS, bool)
                    seen[columns[a:z]] = True
                    df += seen
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["column", "n"])

    rows = docs.select("text").mapInArrow(work, "column long, n long").groupBy("column").agg(F.sum("n").alias("n")).toArrow()
    column, n = rows["column"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(1 << BITS, np.int64)
    out[column[column >= 0]] = n[column >= 0]
    return out, int(n[column < 0].sum())


def picked_texts(known: DataFrame, n: int, sample: int, floor: int) -> DataFrame:
    """Different (lang, text) among the n rows of known(text, lang): about ``sample``, and about ``floor`` of each language."""
    sizes = known.where("lang IS NOT NULL").groupBy("lang").count().collect()
    shares = {r.lang: min(1.0, max(sample / n, floor / r["count"])) for r in sizes}
    most = (1 << 63) - 1
    limit = F.create_map(*(F.lit(x) for lang, share in shares.items() for x in (lang, int(share * most) if share < 1 else most)))
    chosen = F.xxhash64("text").bitwiseAND(F.lit(most)) <= F.element_at(limit, F.col("lang"))
    return known.where(chosen).select("lang", "text").distinct()


def train(docs: DataFrame, sample: int = SAMPLE, floor: int = FLOOR) -> Model:
    """Learn from docs(text, lang). About ``sample`` documents, and ``floor`` more per language, reach the driver."""
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", F.col("lang").cast("string").alias("lang"))
    df, n = document_counts(known)
    if not n:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    picked = picked_texts(known, n, sample, floor).toPandas().sort_values(["lang", "text"], kind="stable")
    idf = np.log((1 + n) / (1 + df)) + 1
    langs = sorted(set(picked["lang"]))
    rows = [_row(x, idf) for x in picked["text"]]
    label = np.array([langs.index(x) for x in picked["lang"]], np.int64)
    order = np.random.default_rng(7).permutation(len(rows))
    cut = max(1, len(rows) * 4 // 5)
    weights, bias = _ftrl([rows[k] for k in order[:cut]], label[order[:cut]], len(langs))
    temperature = _temperature([rows[k] for k in order[cut:]], label[order[cut:]], weights, bias)
    return Model(langs, (weights * idf[:, None] / temperature).astype(np.float32), bias / temperature)


def _row(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    columns, n = np.unique(features([text])[0], return_counts=True)
    return columns, n / n.sum() * idf[columns]


def _ftrl(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal on mini-batches; the last column is the bias, which has no penalty."""
    width = (1 << BITS) + 1
    z, n = np.zeros((width, langs)), np.zeros((width, langs))
    for epoch in range(EPOCHS):
        order = np.random.default_rng(epoch).permutation(len(rows))
        for at in range(0, len(order), BATCH):
            which = order[at : at + BATCH]
            size = [len(rows[k][0]) + 1 for k in which]
            column = np.concatenate([np.append(rows[k][0], width - 1) for k in which])
            value = np.concatenate([np.append(rows[k][1], 1.0) for k in which])
            used, back = np.unique(column, return_inverse=True)
            w = _weights(z[used], n[used], used == width - 1)
            begin = np.cumsum(size) - size
            p = _softmax(np.add.reduceat(w[back] * value[:, None], begin, axis=0))
            p[np.arange(len(which)), label[which]] -= 1
            g = np.stack([np.bincount(back, weights=np.repeat(p[:, j], size) * value, minlength=len(used)) for j in range(langs)], axis=1)
            step = (np.sqrt(n[used] + g**2) - np.sqrt(n[used])) / ALPHA
            z[used] += g - step * w
            n[used] += g**2
    w = _weights(z, n, np.arange(width) == width - 1)
    return w[:-1], w[-1]


def _weights(z: np.ndarray, n: np.ndarray, free: np.ndarray) -> np.ndarray:
    l1 = np.where(free, 0.0, L1)[:, None]
    l2 = np.where(free, 0.0, L2)[:, None]
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + l2))


def _temperature(rows: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> float:
    """The temperature with the least log loss on rows that training has not seen."""
    if not rows:
        return 1.0
    z = np.stack([value @ weights[column] + bias for column, value in rows])
    grid = np.geomspace(0.05, 10, 60)
    loss = [-np.log(np.maximum(_softmax(z / t)[np.arange(len(label)), label], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def predict(docs: DataFrame, model: Model, held: str = HELD) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of docs(doc_id, text, ..)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch["text"].to_pylist())
            yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.expr(held), F.lit(False)).alias("held_out"), "text").mapInArrow(work, SCHEMA)


def identify(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out, predict all."""
    return predict(docs, train(docs.where(f"NOT coalesce({HELD}, false)")))


def keep_known(docs: DataFrame, least: float = 0.0) -> DataFrame:
    """docs whose language is found with a score of at least ``least``; rows and columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs.where(f"NOT coalesce({HELD}, false)")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch["text"].to_pylist())
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))
        give_back()

    return docs.mapInArrow(work, docs.schema)
