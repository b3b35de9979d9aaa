"""Embedding near-dedup by a robust-pruned flat graph.

Equal vectors of a label are one node with a multiplicity. Nodes are dealt to the ``OVERLAP`` nearest of sampled centres
(about ``CENTRES`` and ``CENTRE_BYTES`` at most, so the broadcast is bounded, and none within ``APART`` of another); the nodes of a centre and label are a cluster, cut into blocks
of about ``BLOCK``. In each block a graph is built: of the candidates in descending similarity a node keeps the next one
unless a kept one is nearer to it by the factor ``ALPHA`` (robust pruning), ``DEGREE`` at most. A node's adjacency is the
union of those in its blocks, in either direction. Every pair of blocks of a cluster is searched: each node of one starts from the medoids of
``MEDOIDS`` slices of the other and from its own neighbours there, follows the best ``BEAM`` nodes until they no longer
change, and then expands over all neighbours within ``REACH``, and over what its own neighbours have in reach, until
nothing new is in range. Similarities are computed in double precision for the visited
nodes alone, and a link is a visited pair at ``LINK`` or more. A pair that meets in several clusters counts in the first.

No pairs leave a task: it gives link counts per node and a spanning forest of its links.

Rules: vectors that are null, zero, or hold null or non-finite components, and rows without label or vec_id, link with
nothing and stand alone. Vectors of different length never link. Rows that share vec_id, label and vector are one vector.
Rows that share vec_id alone are different vectors: each has its own links, and may link with the others.
An empty table gives no rows. Columns other than vec_id, embedding and label are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warcloom.llm.components import components
from warcloom.llm.stored import stored

LINK, REACH, APART = 0.93, 0.86, 0.7
CENTRES, PER_CENTRE, OVERLAP, BLOCK = 65_536, 300, 3, 600
CENTRE_BYTES = 64 << 20
DEGREE, ALPHA, BEAM, MEDOIDS = 20, 1.2, 12, 16
_NODE = pa.schema([("shelf", pa.string()), ("node", pa.int64()), ("copies", pa.int64()), ("unit", pa.binary()), ("cluster", pa.int32()), ("clusters", pa.list_(pa.int32()))])
NODE = "shelf string, node long, copies long, unit binary, cluster int, clusters array<int>"


def units(vectors: DataFrame) -> DataFrame:
    """(vec_id, shelf, unit): label and length together as text, and the vector at length one, as bytes of doubles; null if it can't link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, vec_id, x in zip(batch["label"].to_pylist(), batch["vec_id"].to_pylist(), batch["embedding"].to_pylist(), strict=True):
                unit = None if x is None or label is None or vec_id is None or None in x else _unit(x)
                out.append((None if unit is None else f"{len(unit)}:{label}", None if unit is None else unit.tobytes()))
            yield pa.record_batch([batch["vec_id"], pa.array([a for a, _ in out], pa.string()), pa.array([b for _, b in out], pa.binary())], names=["vec_id", "shelf", "unit"])

    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label")]
    return vectors.select(*columns).mapInArrow(work, "vec_id long, shelf string, unit binary")


def _unit(x: list[float]) -> np.ndarray | None:
    v = np.array(x, float)
    if not len(v) or not np.isfinite(v).all() or not (top := np.abs(v).max()):
        return None
    v = v / top
    return v / np.sqrt(v @ v)


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per row of vectors(vec_id, embedding, label, ..): n_links, component_id and kept."""
    rows = stored(units(vectors))
    nodes = rows.where("unit IS NOT NULL").distinct().groupBy("shelf", "unit").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()))  # numbers of the stored table, so a retry can't change them
    found = stored(search(nodes))
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    parts = components(found.where("b IS NOT NULL").select("a", "b")).join(nodes.select("node", "first_id"), "node")
    names = parts.groupBy("component").agg(F.min("first_id").alias("component_id"))
    parts = parts.join(names, "component").select("node", "component_id")
    known = nodes.join(counts.select(F.col("a").alias("node"), "n"), "node", "left").join(parts, "node", "left")
    known = known.select("shelf", "unit", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "first_id").alias("component_id"))
    out = rows.join(known, ["shelf", "unit"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def search(nodes: DataFrame) -> DataFrame:
    """(a, b, n) for nodes(shelf, node, copies, unit, ..): rows with b are links, rows without it give a's linked copies."""
    n, size = nodes.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("unit")), F.lit(0))).first()
    placed = stored(_assigned(nodes.select("shelf", "node", "copies", "unit"), max(PER_CENTRE, -(-n // CENTRES), -(-size // CENTRE_BYTES))))
    size = placed.groupBy("shelf", "cluster").agg(F.count("*").alias("size"))
    placed = placed.join(size, ["shelf", "cluster"]).withColumn("blocks", F.expr(f"CAST(ceil(size / {BLOCK}) AS int)"))
    placed = stored(placed.withColumn("block", F.expr("CAST(pmod(xxhash64(unit, 1), blocks) AS int)")).drop("size"))
    edges = placed.groupBy("shelf", "cluster", "block").applyInArrow(_block_graph, "node long, neighbours array<long>")
    joined = edges.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    pairs = placed.join(joined, "node", "left").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    return pairs.groupBy("shelf", "cluster", "low", "high").applyInArrow(_block_links, "a long, b long, n long")


def _assigned(nodes: DataFrame, every: int) -> DataFrame:
    """Each node once for each of its nearest centres; centres are the nodes that a hash picks, one of ``every``."""
    picked = nodes.where(F.expr(f"pmod(xxhash64(unit), {every}L) = 0")).select("shelf", "unit").toArrow()
    centres: dict[str, list[np.ndarray]] = {}
    for shelf, unit in sorted(zip(picked["shelf"].to_pylist(), picked["unit"].to_pylist(), strict=True)):
        centres.setdefault(shelf, []).append(np.frombuffer(unit))
    shared = nodes.sparkSession.sparkContext.broadcast({k: _apart(x) for k, x in centres.items()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for shelf, unit, node, copies in zip(*(batch[c].to_pylist() for c in ("shelf", "unit", "node", "copies")), strict=True):
                centre = shared.value.get(shelf)
                own = [0] if centre is None else np.argsort(-(centre @ np.frombuffer(unit)), kind="stable")[:OVERLAP].tolist()
                rows += [(shelf, node, copies, unit, k, own) for k in own]
            columns = list(zip(*rows, strict=True)) or [()] * len(_NODE)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _NODE, strict=True)], schema=_NODE)

    return nodes.mapInArrow(work, NODE)


def _apart(centres: list[np.ndarray]) -> np.ndarray:
    """Centres without those too near to an earlier one: a dense spot has one, so that its nodes share a cluster."""
    kept = np.empty((len(centres), len(centres[0])))
    n = 0
    for c in centres:
        if not n or (kept[:n] @ c).max() < APART:
            kept[n] = c
            n += 1
    return kept[:n]


def _matrix(rows: pa.Table) -> np.ndarray:
    return np.stack([np.frombuffer(x) for x in rows["unit"].to_pylist()])


def _block_graph(rows: pa.Table) -> pa.Table:
    ids = rows["node"].to_numpy()
    near = both_ways(robust_graph(_matrix(rows)))
    return pa.table([rows["node"], pa.array([ids[x].tolist() for x in near], pa.list_(pa.int64()))], names=["node", "neighbours"])


def both_ways(near: np.ndarray) -> list[list[int]]:
    """Neighbours in either direction: in a dense spot some nodes are no one's neighbour and could not be found."""
    out: list[set[int]] = [set() for _ in near]
    for a, own in enumerate(near.tolist()):
        for b in own:
            if b >= 0:
                out[a].add(b)
                out[b].add(a)
    return [sorted(x) for x in out]


def robust_graph(x: np.ndarray) -> np.ndarray:
    """Neighbours of each row of unit vectors, at most DEGREE, -1 for none. Distances are squared Euclidean."""
    n = len(x)
    distance = np.maximum(2 - 2 * (x @ x.T), 0)
    left = distance.copy()
    np.fill_diagonal(left, np.inf)
    out = np.full((n, DEGREE), -1, np.int64)
    every = np.arange(n)
    for k in range(min(DEGREE, n - 1)):
        best = left.argmin(axis=1)
        some = np.isfinite(left[every, best])
        out[some, k] = best[some]
        left[every, best] = np.inf
        left[(ALPHA * distance[best] <= distance) & some[:, None]] = np.inf
    return out


def _block_links(rows: pa.Table) -> pa.Table:
    """Links between the two blocks of a pair, or within one."""
    block = rows["block"].to_numpy()
    ids, copies, x = rows["node"].to_numpy(), rows["copies"].to_numpy(), _matrix(rows)
    place = {v: k for k, v in enumerate(ids.tolist())}
    near = [[place[v] for v in own or () if v in place] for own in rows["neighbours"].to_pylist()]
    low, high = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    if rows["low"][0].as_py() != rows["high"][0].as_py() and block.min() == block.max():
        return _links_table([], [], [])
    found = graph_search(x, near, low, high)
    clusters = rows["clusters"].to_pylist()
    here = rows["cluster"][0].as_py()
    links = {(min(a, b), max(a, b)) for a, b in found if a != b and min(set(clusters[a]) & set(clusters[b])) == here}
    count = np.zeros(len(ids), np.int64)
    above = list(range(len(ids)))

    def top(v: int) -> int:
        while above[v] != v:
            above[v] = above[above[v]]
            v = above[v]
        return v

    forest = []
    for a, b in links:
        count[a] += copies[b]
        count[b] += copies[a]
        if (p := top(a)) != (q := top(b)):
            above[max(p, q)] = min(p, q)
            forest.append((a, b))
    some = np.flatnonzero(count)
    return _links_table(ids[[a for a, _ in forest] + some.tolist()], [*ids[[b for _, b in forest]].tolist(), *[None] * len(some)], [0] * len(forest) + count[some].tolist())


def _links_table(a, b, n) -> pa.Table:
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])


def graph_search(x: np.ndarray, near: list[list[int]], queries: np.ndarray, targets: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (query, target) at LINK or more that range-expanding greedy search finds, all queries in step."""
    allowed = np.zeros(len(x), bool)
    allowed[targets] = True
    width = max(map(len, near), default=0)
    table = np.full((len(x), max(width, 1)), -1, np.int64)
    for k, own in enumerate(near):
        table[k, : len(own)] = own
    n = len(queries)
    asks = np.full(len(x), -1, np.int64)
    asks[queries] = np.arange(n)
    score = np.full((n, len(x)), -2.0)  # similarity of visited nodes
    opened = np.zeros((n, len(x)), bool)
    starts = [part[int(np.argmax(x[part] @ x[part].mean(axis=0)))] for part in np.array_split(targets, min(MEDOIDS, len(targets)))]

    def visit(row: np.ndarray, node: np.ndarray) -> None:
        fresh = (node >= 0) & allowed[node] & (score[row, node] == -2.0)
        row, node = row[fresh], node[fresh]
        for a in range(0, len(row), 1 << 16):
            r, v = row[a : a + (1 << 16)], node[a : a + (1 << 16)]
            score[r, v] = np.einsum("ij,ij->i", x[queries[r]], x[v])

    every = np.arange(n)
    for start in starts:
        visit(every, np.full(n, start))
    visit(np.repeat(every, table.shape[1]), table[queries].ravel())
    visit(every, queries)
    while True:  # greedy: open the best few that are not open yet
        best = np.argpartition(-score, min(BEAM, score.shape[1] - 1), axis=1)[:, :BEAM]
        todo = ~np.take_along_axis(opened, best, axis=1) & (np.take_along_axis(score, best, axis=1) > -2.0)
        row, k = np.nonzero(todo)
        if not len(row):
            break
        _open(row, best[row, k], opened, table, visit)
    own = asks[table[queries]]  # a query's neighbours that are queries, too
    row, k = np.nonzero((table[queries] >= 0) & (own >= 0))
    friend = own[row, k]
    while True:
        while True:  # expand over everything in reach
            q, node = np.nonzero((score >= REACH) & ~opened)
            if not len(q):
                break
            _open(q, node, opened, table, visit)
        near_by = score >= REACH  # what a neighbouring query has in reach is where to look, too
        seen = int((score > -2.0).sum())
        for a in range(0, len(row), 1 << 12):
            e, node = np.nonzero(near_by[friend[a : a + (1 << 12)]] & (score[row[a : a + (1 << 12)]] == -2.0))
            pair = np.unique(row[a : a + (1 << 12)][e] * len(x) + node)
            visit(pair // len(x), pair % len(x))
        if int((score > -2.0).sum()) == seen:
            break
    row, node = np.nonzero(score >= LINK)
    return list(zip(queries[row].tolist(), node.tolist(), strict=True))


def _open(row: np.ndarray, node: np.ndarray, opened: np.ndarray, table: np.ndarray, visit) -> None:
    opened[row, node] = True
    size = max(1, (1 << 21) // table.shape[1])
    for a in range(0, len(row), size):
        own = table[node[a : a + size]]
        query, own = np.repeat(row[a : a + size], own.shape[1]), own.ravel()
        pair = np.unique((query * len(table) + own)[own >= 0])
        visit(pair // len(table), pair % len(table))


def audit_recall(vectors: DataFrame, result: DataFrame, every: int = 100, block: int = 1000) -> float:
    """Share of the true links that ``result`` counts, for the vectors whose id is divisible by ``every``, by brute force
    against all rows in blocks of queries."""
    rows = stored(units(vectors).where("unit IS NOT NULL"))
    spark = vectors.sparkSession
    asked = rows.where(f"vec_id % {every} = 0").orderBy("vec_id").toLocalIterator()
    true = have = 0
    done = False
    while not done:
        part = [r for _, r in zip(range(block), asked, strict=False)]
        done = len(part) < block
        if not part:
            break
        shared = spark.sparkContext.broadcast(part)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, shelves, units_ = (batch[c].to_pylist() for c in ("vec_id", "shelf", "unit"))
                n = [sum(r.shelf == s and r.vec_id != v and float(np.frombuffer(r.unit) @ np.frombuffer(u)) >= LINK for v, s, u in zip(ids, shelves, units_, strict=True)) for r in shared.value]
                yield pa.record_batch([pa.array([r.vec_id for r in shared.value]), pa.array(n, pa.int64())], names=["vec_id", "n"])

        exact = rows.mapInArrow(work, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
        got = exact.join(result, "vec_id").agg(F.sum("n"), F.sum(F.least("n", "n_links"))).first()
        true, have = true + (got[0] or 0), have + (got[1] or 0)
    return have / true if true else 1.0
