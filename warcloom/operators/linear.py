"""Linear text classifiers: scores within the row, and training by one-vs-rest support vector machines.

A model is a table (class, term, weight), a bias per class and, where texts are weighed by normalised TF-IDF, the IDF of its
terms. To score rows where they are, a model is collected, which its size in bytes must allow, and broadcast: a row's
tokens are looked up in a hash table of terms, counted, and multiplied into one score per class. Neither texts nor tokens
leave their row, so there is no shuffle and no hot word. Models above the bound stay tables and go through
`classify.class_scores`, a join; `usable_model` decides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import IDF, CountVectorizer, Normalizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warcloom.operators import classify
from warcloom.operators.counted import as_column, pieces
from warcloom.session import stored

MODEL_BYTES = 256 << 20
#: Terms of a trained model at most: the most frequent ones.
VOCABULARY = 1 << 18
_CHUNK = 1 << 21


@dataclass(frozen=True)
class LinearModel:
    """Classes in order with their biases; terms with weights as rows (begin, classes, weights); their IDF or None."""

    classes: list[str]
    bias: np.ndarray
    terms: pa.Array
    begin: np.ndarray
    of_class: np.ndarray
    weight: np.ndarray
    idf: np.ndarray | None = None

    def scores(self, tokens: pa.ListArray) -> np.ndarray:
        """A score per row and class. Rows without tokens have the biases."""
        n = len(self.classes)
        out = np.tile(self.bias, (len(tokens), 1))
        ends = np.cumsum(pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False))
        a = 0
        while a < len(tokens):  # rows of a million tokens or so at a time; a longer text alone
            z = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + _CHUNK, side="right")), a + 1)
            row, term, value = self._weighed(tokens.slice(a, z - a))
            size = self.begin[term + 1] - self.begin[term]
            for low, high in pieces(size, _CHUNK):
                s = size[low:high]
                which = np.repeat(self.begin[term[low:high]] - (np.cumsum(s) - s), s) + np.arange(s.sum())
                cell = np.repeat(row[low:high], s) * n + self.of_class[which]
                out[a:z] += np.bincount(cell, np.repeat(value[low:high], s) * self.weight[which], (z - a) * n).reshape(-1, n)
            a = z
        return out

    def _weighed(self, tokens: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, value) of the known terms of rows: counts, over the norm of counts times IDF if there is one."""
        at = pc.index_in(pc.list_flatten(tokens), value_set=self.terms)
        known = pc.is_valid(at).to_numpy(zero_copy_only=False)
        row = pc.list_parent_indices(tokens).to_numpy(zero_copy_only=False)[known].astype(np.int64)
        cell, tf = np.unique(row * max(len(self.terms), 1) + at.drop_null().to_numpy(zero_copy_only=False), return_counts=True)
        row, term = np.divmod(cell, max(len(self.terms), 1))
        if self.idf is None:
            return row, term, tf.astype(float)
        norm = np.sqrt(np.bincount(row, (tf * self.idf[term]) ** 2, len(tokens)))
        return row, term, tf / np.maximum(norm[row], 1e-300)


def collect_model(model: DataFrame, bias: DataFrame, idf: DataFrame | None = None, limit: int = MODEL_BYTES) -> LinearModel:
    """A model (class, term, weight), (class, bias), (term, idf) as a value that tasks can hold; an error if it is larger
    than `limit` bytes. Several weights of a class and term are added, classes without a bias have none to add."""
    rows, size = _summed(model)
    if size > limit:
        raise ValueError(f"a model of {size} bytes does not fit into {limit}; score it by a join")
    return _collected(rows, bias, idf)


@dataclass(frozen=True)
class StoredModel:
    """A model larger than a task may hold, as tables (class, term, weight) and (class, bias) with a row for every class."""

    model: DataFrame
    bias: DataFrame


def usable_model(model: DataFrame, bias: DataFrame, limit: int | None = None) -> LinearModel | StoredModel:
    """A model (class, term, weight), (class, bias) as a value for tasks, or as tables if it has more than `limit` bytes
    (MODEL_BYTES). Steps take both, with the same results."""
    rows, size = _summed(model)
    if size <= (MODEL_BYTES if limit is None else limit):
        return _collected(rows, bias)
    every = rows.select("class").distinct().join(bias.filter("class IS NOT NULL").groupBy("class").agg(F.last("bias").alias("bias")), "class", "full")
    return StoredModel(rows, stored(every.select("class", F.coalesce("bias", F.lit(0.0)).alias("bias")), "model"))


def _summed(model: DataFrame) -> tuple[DataFrame, int]:
    """One stored row per class and term, and their bytes."""
    rows = model.filter("term IS NOT NULL AND class IS NOT NULL").groupBy("class", "term").agg(F.sum("weight").alias("weight"))
    rows = stored(rows, "model")
    n, text = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term") + F.octet_length("class")), F.lit(0))).first()
    return rows, text + 16 * n


def _collected(rows: DataFrame, bias: DataFrame, idf: DataFrame | None = None) -> LinearModel:
    table = rows.select("term", "class", "weight").toArrow().sort_by([("term", "ascending"), ("class", "ascending")])
    biases = {r["class"]: float(r["bias"]) for r in bias.filter("class IS NOT NULL").collect()}
    classes = sorted(set(biases) | set(table["class"].to_pylist()))
    place = {name: k for k, name in enumerate(classes)}
    term = table["term"].combine_chunks().cast(pa.string())
    codes = term.dictionary_encode()
    terms, index = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False)
    begin = np.searchsorted(index, np.arange(len(terms) + 1))
    weigh = None
    if idf is not None:
        known = {r["term"]: float(r["idf"]) for r in idf.collect()}
        more = pa.array(sorted(set(known) - set(terms.to_pylist())), pa.string())  # count in the norm only
        terms = pa.concat_arrays([terms, more])
        begin = np.concatenate([begin, np.full(len(more), len(table))])
        weigh = np.array([known.get(t, 0.0) for t in terms.to_pylist()])
    return LinearModel(
        classes,
        np.array([biases.get(c, 0.0) for c in classes]),
        terms,
        begin.astype(np.int64),
        np.array([place[c] for c in table["class"].to_pylist()], np.int64),
        table["weight"].to_numpy().astype(float),
        weigh,
    )


def _by_row(spark, model: LinearModel, kind: str, result: Callable[[LinearModel, np.ndarray], pa.Array]) -> Callable[[Column], Column]:
    shared = spark.sparkContext.broadcast(model)

    def work(tokens: pa.Array) -> pa.Array:
        found = result(shared.value, shared.value.scores(tokens))
        return pc.if_else(pc.fill_null(pc.greater(pc.list_value_length(tokens), 0), False), found, pa.scalar(None, found.type))

    return F.arrow_udf(work, kind)


def topics_of(spark, model: LinearModel) -> Callable[[Column], Column]:
    """Expression of an array of tokens: the sorted classes with a positive score; null without tokens."""

    def positive(known: LinearModel, scores: np.ndarray) -> pa.Array:
        row, column = np.nonzero(scores > 0)
        names = pa.array(known.classes, pa.string()).take(pa.array(column))
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(scores) + 1)), pa.int32()), names)

    return _by_row(spark, model, "array<string>", positive)


def sentiment_of(spark, model: LinearModel, positive: str = "positive", negative: str = "negative") -> Callable[[Column], Column]:
    """Expression of an array of tokens: p(positive) - p(negative) of a softmax, in [-1, 1]; null without tokens."""
    missing = {positive, negative} - set(model.classes)
    if missing:
        raise ValueError(f"the model has no class {sorted(missing)[0]!r}")
    p, n = model.classes.index(positive), model.classes.index(negative)
    return _by_row(spark, model, "double", lambda _, scores: pa.array(np.tanh((scores[:, p] - scores[:, n]) / 2)))


def with_scored(records: DataFrame, output: str, tokens: Column, found: StoredModel, result: Callable[[DataFrame, str, DataFrame], DataFrame]) -> DataFrame:
    """Records with the `output` that `result` makes of their class scores by a stored model; null without tokens.

    Records are written once with a number, by which the scores of their tokens come back to them.
    """
    rows = stored(records.drop(output).withColumns({"_row": F.monotonically_increasing_id(), "_tokens": tokens}), "records")
    scores = classify.class_scores(rows.filter(F.size("_tokens") > 0), "_row", "_tokens", found.model, found.bias)
    return rows.drop("_tokens").join(result(scores, "_row", found.bias), "_row", "left").drop("_row")


def fit_svm(
    texts: DataFrame,
    key: str,
    tokens: str | Column,
    labels: DataFrame,
    regularisation: float = 1e-3,
    iterations: int = 100,
    min_texts: int = 2,
    vocabulary: int = VOCABULARY,
    depth: int = 2,
    parallelism: int = 4,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One linear support vector machine per class, over normalised TF-IDF vectors of the labelled texts.

    `labels` has (key, class), several per text if need be; a text belongs to the rest of every class it does not have.
    Terms of fewer than `min_texts` texts, and those behind the `vocabulary` most frequent, are left out. Each machine
    minimises mean hinge loss plus `regularisation`/2 times the squared weights; gradients are summed over the cluster in a
    tree of `depth` levels. Tokens, counts and vectors are computed once and stored; `parallelism` machines are trained at
    a time. Texts or labels that are null, and texts without tokens, teach nothing.

    Returns (class, term, weight), (class, bias) and (term, idf), for `collect_model`. Weights have their IDF in them.
    """
    spark = texts.sparkSession
    classes = labels.filter("class IS NOT NULL").groupBy(key).agg(F.collect_set("class").alias("_classes"))
    # tokens are made behind the join, which then moves texts as they are, and once
    known = texts.join(classes, key).select(as_column(tokens).alias("_made"), "_classes")
    known = known.select(F.filter("_made", lambda t: t.isNotNull()).alias("_tokens"), "_classes", (F.size("_made") > 0).alias("_any"))
    names = sorted(r[0] for r in labels.select("class").distinct().collect() if r[0] is not None)
    counted = stored(known, "labelled").filter("_any").drop("_any")
    if not names or counted.isEmpty():
        return tuple(spark.createDataFrame([], s) for s in ("class string, term string, weight double", "class string, bias double", "term string, idf double"))
    counts = CountVectorizer(inputCol="_tokens", outputCol="_tf", vocabSize=vocabulary, minDF=float(min_texts)).fit(counted)
    if not counts.vocabulary:
        raise ValueError(f"no term occurs in {min_texts} texts")
    vocabulary_counts = stored(counts.transform(counted).select("_tf", "_classes"), "counts")
    weigh = IDF(inputCol="_tf", outputCol="_tfidf").fit(vocabulary_counts)
    vectors = Normalizer(inputCol="_tfidf", outputCol="features").transform(weigh.transform(vocabulary_counts))
    vectors = stored(vectors.select("features", "_classes"), "vectors")
    idf = weigh.idf.toArray()

    def fit(name: str) -> tuple[np.ndarray, float]:
        own = vectors.select("features", F.array_contains("_classes", name).cast("double").alias("label"))
        machine = LinearSVC(regParam=regularisation, maxIter=iterations, standardization=False, aggregationDepth=depth).fit(own)
        return machine.coefficients.toArray(), machine.intercept

    with ThreadPool(min(parallelism, len(names))) as pool:
        made = pool.map(inheritable_thread_target(spark)(fit), names)
    parts = []
    for name, (weights, _) in zip(names, made, strict=True):
        used = np.flatnonzero(weights)
        terms = pa.array(counts.vocabulary, pa.string()).take(pa.array(used))
        parts.append(pa.table({"class": pa.array([name] * len(used), pa.string()), "term": terms, "weight": weights[used] * idf[used]}))
    model = spark.createDataFrame(pa.concat_tables(parts))
    bias = spark.createDataFrame([(name, float(b)) for name, (_, b) in zip(names, made, strict=True)], "class string, bias double")
    return model, bias, spark.createDataFrame(pa.table({"term": pa.array(counts.vocabulary, pa.string()), "idf": idf}))
