"""Terms of texts counted within tasks, chunk by chunk, so that shuffles move a chunk's distinct terms and not its tokens."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warcloom.session import stored

#: Tokens of a chunk, about; a longer text is a chunk of its own.
CHUNK = 1 << 21
#: Tokens that are counted, stored and scored at a time, with four times as many weights.
PIECE = 1 << 16
#: Bytes of a row group of stored pieces, which a task reads at a time.
_GROUP_BYTES = 4 << 20
#: The C library's call, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def as_column(tokens: str | Column) -> Column:
    return F.col(tokens) if isinstance(tokens, str) else tokens


def give_back() -> None:
    """Free memory of this worker process goes back to the system, as workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a column `tokens`, in slices of about CHUNK tokens."""
    for batch in batches:
        ends = _ends(batch["tokens"])
        a = 0
        while a < len(ends):
            z = max(int(np.searchsorted(ends, (ends[a - 1] if a else 0) + CHUNK, side="right")), a + 1)
            yield batch.slice(a, z - a)
            give_back()
            a = z
        del batch  # before the next one is read


def _ends(tokens: pa.ListArray) -> np.ndarray:
    return np.cumsum(pc.list_value_length(tokens).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)


def counted(tokens: pa.ListArray, group: np.ndarray | None = None, piece: int = PIECE) -> tuple[pa.Array, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """Distinct terms, and for each `piece` tokens (cell, occurrences) by cell, the text's row, or its number in `group`, times
    the number of terms plus the term's place. Null tokens are none. A text may go on in the next piece."""
    codes = pc.list_flatten(tokens).cast(pa.string()).dictionary_encode()
    index, ends = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False), _ends(tokens)
    width = max(len(codes.dictionary), 1)

    def cells() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a in range(0, len(index), piece):
            term = index[a : a + piece].astype(np.int64)
            row = np.searchsorted(ends, np.arange(a, a + len(term)), side="right")
            row, term = row[term >= 0], term[term >= 0]
            if len(row):
                yield np.unique((row if group is None else group[row]) * width + term, return_counts=True)

    return codes.dictionary, cells()


def counts_by_classes(rows: DataFrame) -> DataFrame:
    """(classes, term, n) of rows(tokens, classes): occurrences of a term in the texts that have these very classes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            own = [tuple(x) for x in chunk["classes"].to_pylist()]
            sets = {x: k for k, x in enumerate(dict.fromkeys(own))}
            terms, cells = counted(chunk["tokens"], np.array([sets[x] for x in own], np.int64))
            del chunk
            if found := list(cells):
                cell, back = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
                n = np.bincount(back, np.concatenate([x for _, x in found])).astype(np.int64)
                del found, back
                of, term = np.divmod(cell, len(terms))
                listed = pa.array([list(x) for x in sets], pa.list_(pa.string()))
                yield pa.record_batch([listed.take(pa.array(of)), terms.take(pa.array(term)), pa.array(n)], names=["classes", "term", "n"])

    counts = rows.select("tokens", "classes").mapInArrow(work, "classes array<string>, term string, n long")
    return counts.groupBy("classes", "term").agg(F.sum("n").alias("n"))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers of four bytes, first bytes first: bytes that are alike stand together, which compresses."""
    return numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(data.as_buffer(), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


_PIECE_OF = "size int, counts binary, term binary, tf binary"


def sums_by_class(texts: DataFrame, key: str, tokens: str | Column, model: DataFrame) -> DataFrame:
    """(key, class, total): per text and class the sum of its tokens' weights in model(class, term, weight), in one row or
    several to be added.

    Texts of a chunk ask for the weights of their distinct terms, each once, and are scored by the answers. So the join has
    a row per chunk and distinct term, a frequent term as many as there are chunks. A class without a term of the text has
    no row; a text with a token that the model lacks has one with a null class.

    A chunk is stored and shuffled in pieces, of which the largest row holds PIECE tokens, and is scored piece by piece. A
    worker holds one chunk's answers and packed pieces, however many chunks its task gets.
    """
    rows = texts.select(F.col(key).alias("key"), as_column(tokens).alias("tokens"))
    of_key = rows.schema["key"].dataType
    kind = T.StructType([*T._parse_datatype_string("part long, first int, terms array<string>"), T.StructField("keys", T.ArrayType(of_key)), *T._parse_datatype_string(_PIECE_OF)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, chunk in enumerate(chunks(batches)):
            keys, (terms, cells) = chunk["key"], counted(chunk["tokens"], piece=PIECE)
            del chunk
            listed = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            types = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(keys.type), pa.int32(), *[pa.binary()] * 3]

            def row_of(**own: pa.Array) -> pa.RecordBatch:
                own["part"] = pa.array([first + k])  # noqa: B023
                return pa.record_batch([own.get(c, pa.nulls(1, t)) for c, t in zip(kind.fieldNames(), types, strict=True)], names=kind.fieldNames())  # noqa: B023

            for a in range(0, len(terms), PIECE):
                yield row_of(first=pa.array([a], pa.int32()), terms=listed(terms.slice(a, PIECE)))
            for cell, tf in cells:
                row, term = np.divmod(cell, len(terms))
                low, high = int(row[0]), int(row[-1]) + 1
                numbers = {c: pa.array([_packed(x)], pa.binary()) for c, x in (("counts", np.bincount(row - low)), ("term", term), ("tf", tf))}
                yield row_of(size=pa.array([len(terms)], pa.int32()), keys=listed(keys.slice(low, high - low)), **numbers)
            del keys, terms, cells

    parts = stored(rows.mapInArrow(deal, kind), "texts", _GROUP_BYTES)
    asked = parts.filter("terms IS NOT NULL").select(F.col("part").alias("of"), "first", F.posexplode("terms").alias("at", "term"))
    by_term = model.filter("term IS NOT NULL").groupBy("term").agg(F.collect_list(F.struct("class", "weight")).alias("w"))
    found = asked.join(by_term, "term").select("of", (F.col("first") + F.col("at")).alias("at"), F.col("w.class").alias("classes"), F.col("w.weight").alias("weights"))
    sums = T.StructType([T.StructField(key, of_key), *T._parse_datatype_string("class string, total double")])
    texts_of = parts.filter("terms IS NULL").drop("first", "terms")
    return texts_of.groupBy("part").cogroup(found.groupBy("of")).applyInArrow(_scorer(key), sums)


def _scorer(key: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(part: pa.Table, found: pa.Table) -> pa.Table:
        names: dict[str | None, int] = {None: 0}
        weights = _by_place([_numbered(x, names) for x in found.to_batches()], part["size"][0].as_py())
        made = [_sums(key, x, k, weights, names) for x in part.to_batches() for k in range(len(x))]
        del weights
        give_back()
        return pa.Table.from_batches(made)

    return score


def _numbered(found: pa.RecordBatch, names: dict[str | None, int]) -> tuple[np.ndarray, ...]:
    """Places of terms, and how many weights, of which classes and which each has. Classes new to `names` get a number."""
    codes = pc.list_flatten(found["classes"]).cast(pa.string()).dictionary_encode()
    numbers = np.array([*(names.setdefault(x, len(names)) for x in codes.dictionary.to_pylist()), 0], np.int32)
    of_class = numbers[codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)]
    n = pc.list_value_length(found["classes"]).to_numpy(zero_copy_only=False)
    weight = pc.list_flatten(found["weights"]).to_numpy(zero_copy_only=False)
    return found["at"].to_numpy(zero_copy_only=False).copy(), n.astype(np.int32), of_class, np.array(weight, float)


def _by_place(answers: list[tuple[np.ndarray, ...]], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For `n` terms how many weights each has and where they begin; classes and weights."""
    size, begin = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not answers:
        return size, begin, np.zeros(0, np.int32), np.zeros(0)
    at, own, of_class, weight = (np.concatenate(x) for x in zip(*answers, strict=True))
    size[at] = own
    begin[at] = np.cumsum(own, dtype=np.int64) - own
    return size, begin, of_class, weight


def _sums(key: str, batch: pa.RecordBatch, k: int, weights: tuple[np.ndarray, ...], names: dict[str | None, int]) -> pa.RecordBatch:
    size, begin, of_class, weight = weights
    keys, (counts, term, tf) = batch["keys"][k].values, (_unpacked(batch[c][k]) for c in ("counts", "term", "tf"))
    row = np.repeat(np.arange(len(keys)), counts)
    width = len(names)
    made = []
    for a, z in pieces(size[term], 4 * PIECE):
        s = size[term[a:z]]
        which = np.repeat(begin[term[a:z]] - (np.cumsum(s) - s), s) + np.arange(s.sum())
        low = row[a]
        made.append(_added(np.repeat(row[a:z] - low, s) * width + of_class[which], np.repeat(tf[a:z], s) * weight[which], low * width))
    unknown = np.unique(row[size[term] == 0]) * width
    cell = np.concatenate([x for x, _ in made] + [unknown])
    total = pa.array(np.concatenate([x for _, x in made] + [np.zeros(len(unknown))]), mask=np.arange(len(cell)) >= len(cell) - len(unknown))
    of, name = np.divmod(cell, width)
    chosen = pa.array([*names], pa.string()).take(pa.array(name))
    return pa.record_batch([keys.take(pa.array(of)), chosen, total.cast(pa.float64())], names=[key, "class", "total"])


def _added(cell: np.ndarray, value: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells, numbered from `first`, and the sums of their values; cells that lie close together are not sorted."""
    if len(cell) and cell.max() < 4 * len(cell):
        distinct = np.flatnonzero(np.bincount(cell))
        return distinct + first, np.bincount(cell, value)[distinct]
    distinct, back = np.unique(cell, return_inverse=True)
    return distinct + first, np.bincount(back, value, len(distinct))


def pieces(size: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of entries that have about `most` weights together."""
    total = np.cumsum(size)
    cuts = np.searchsorted(total, np.arange(most, total[-1], most)) + 1 if len(total) else []
    edges = np.unique(np.concatenate([[0], cuts, [len(size)]])).astype(int).tolist()
    return list(zip(edges, edges[1:], strict=False))
