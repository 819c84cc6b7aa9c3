"""Exact top-k inner product search by columnar branch-and-bound.

Vectors lie in blocks in vertical layout, one row of numbers per dimension. A block of
queries meets a block of candidates; scores grow dimension block by dimension block, and
after each a candidate goes for a query once its score so far plus the most that the
remaining dimensions can add, the product of the remaining norms, falls short of the
query's k-th best score. That floor comes from a sample all queries meet first, so every block
begins with it, and a block passes on only what reaches it. Dimensions come in order of their
energy in the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drover.session import materialize

#: Vectors of a block of candidates and of a block of queries.
BLOCK, QUERIES = 4096, 512
#: Dimensions that are added between two prunings, and candidates of a block that are scored whole first.
STEP, SEED = 16, 256
#: Vectors that give every query its first floor.
SAMPLE = 4096
#: A share of surviving pairs above which it is cheaper to go on with all of them.
DENSE = 0.25


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null if the vector is null, empty or holds a
    component that is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("double"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, whole)


def _blocks(size: int, orders: dict[int, np.ndarray] | None = None):
    """Rows into blocks: (dim, ids, vertical matrix). A partition is cut as it is read. ``orders``
    has the order of dimensions by their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, rows = zip(*held.pop(dim), strict=True)
            matrix = np.array(rows, np.float64).T
            matrix = np.ascontiguousarray(matrix[orders[dim]] if orders and dim in orders else matrix)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([matrix.tobytes()], pa.binary())], names=["dim", "ids", "matrix"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.asarray(v.values, np.float64)
                held.setdefault(len(own), []).append((i, own))
                if len(held[len(own)]) == size:
                    yield block(len(own))
        for dim in sorted(held):
            yield block(dim)

    return run


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by score, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def kth_best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th best score of every query among candidates other than itself, or minus infinity."""
    if c.shape[1] <= k:
        return np.full(len(qid), -np.inf)
    scores = q.T @ c
    scores[qid[:, None] == cid[None, :]] = -np.inf
    return np.partition(scores, c.shape[1] - k, axis=1)[:, c.shape[1] - k]


def search(
    qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, floor: np.ndarray | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of the best ``k`` of a block for every query, of those that reach
    its ``floor``; ``q`` and ``c`` are vertical. Scores are whole numbers held exactly in
    doubles, so bounds that are raised by one part in a million, and by one, never lose a candidate."""
    dims, n = c.shape
    cuts = list(range(0, dims, STEP))
    seeds = min(n, max(SEED, k + 1))
    own_floor = kth_best(qid, q, cid[:seeds], c[:, :seeds], k)
    floor = own_floor if floor is None else np.maximum(floor, own_floor)
    # Norms of what remains after each dimension block.
    rest = lambda m: [np.sqrt((m[a + STEP :] ** 2).sum(axis=0)) for a in cuts]
    rest_q, rest_c = rest(q), rest(c)
    score = np.zeros((len(qid), n))
    alive = None  # (query, candidate) pairs, once they are few
    for at, a in enumerate(cuts):
        b = slice(a, a + STEP)
        if alive is None:
            score += q[b].T @ c[b]
            bound = score + (rest_q[at][:, None] * rest_c[at][None, :]) * (1 + 1e-6) + 1
            keep = bound >= floor[:, None]
            if at + 1 < len(cuts) and keep.mean() <= DENSE:
                rows, cols = np.nonzero(keep)
                alive = (rows, cols, score[rows, cols])
        else:
            rows, cols, own = alive
            own = own + np.einsum("ij,ij->j", q[b][:, rows], c[b][:, cols])
            keep = own + rest_q[at][rows] * rest_c[at][cols] * (1 + 1e-6) + 1 >= floor[rows]
            alive = (rows[keep], cols[keep], own[keep])
    if alive is None:
        rows, cols = np.nonzero(score >= floor[:, None])
        alive = (rows, cols, score[rows, cols])
    rows, cols, own = alive
    foreign = qid[rows] != cid[cols]
    rows, cols, own = rows[foreign], cols[foreign], own[foreign]
    ends = np.searchsorted(rows, np.arange(len(qid) + 1))
    for i in range(len(qid)):
        part = slice(ends[i], ends[i + 1])
        take = _best(own[part], cid[cols[part]], k)
        yield i, cid[cols[part]][take], own[part][take]


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(dim, -1)


def _energy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The dimensions of each block, those with the largest sum of squares first."""
    for batch in batches:
        dims = batch.column(0).to_pylist()
        order = [np.argsort(-(_matrix(m.as_py(), d) ** 2).sum(axis=1), kind="stable") for m, d in zip(batch.column(2), dims, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o.astype(np.int64).tobytes() for o in order], pa.binary())], names=["dim", "energy"])


def _floors(k: int, orders: dict[int, np.ndarray]):
    """Query blocks with the ``k``-th best score of every query in the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floors = []
            for r in range(batch.num_rows):
                dim, qids, qmatrix, ids, matrix = (batch.column(j)[r].as_py() for j in range(5))
                qid = np.frombuffer(qids, np.int64)
                if ids is None:
                    found = np.full(len(qid), -np.inf)
                else:
                    found = kth_best(qid, _matrix(qmatrix, dim), np.frombuffer(ids, np.int64), _matrix(matrix, dim)[orders[dim]], k)
                floors.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(j) for j in range(3)), pa.array(floors, pa.binary())], names=["dim", "qids", "qmatrix", "floors"])

    return run


def top_k(df: DataFrame, key: str, vector: str, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, ``key``, score) of the ``k`` best candidates of every query, all if
    there are fewer; ties go to the smaller key. A query is no candidate of its own, and
    neither is a row that repeats its key.

    Left out, as query and as candidate: null keys and vectors that :func:`quantised` makes
    null. Vectors meet only vectors of their own length. Rows that repeat a key are
    candidates once each; queries that repeat a key count once, by their first vector in
    order of its components. Where products of quantised components could leave the whole numbers
    that a double holds, the call fails.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = materialize(rows.filter("id IS NOT NULL AND v IS NOT NULL"), "vectors")
    largest = F.greatest(F.abs(F.array_max("v")), F.abs(F.array_min("v")))
    n, most = rows.agg(F.count(F.lit(1)), F.max(largest * largest * F.size("v"))).first()
    if most is not None and most >= float(1 << 53):
        raise ValueError("components are too large for exact scores")
    shape = "dim int, ids binary, matrix binary"
    # At most SAMPLE vectors, the least by a hash of their key, in one block per number of dimensions.
    sample = rows.select("id", "v").orderBy(F.xxhash64("id"), "id", "v").limit(SAMPLE).coalesce(1)
    sample = materialize(sample.mapInArrow(_blocks(SAMPLE), shape), "sample")
    orders = {r["dim"]: np.frombuffer(r["energy"], np.int64) for r in sample.mapInArrow(_energy, "dim int, energy binary").collect()}

    asked = rows.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    queries = asked.select("id", "v").mapInArrow(_blocks(QUERIES, orders), shape).select("dim", F.col("ids").alias("qids"), F.col("matrix").alias("qmatrix"))
    met = queries.join(sample, "dim", "left").select("dim", "qids", "qmatrix", "ids", "matrix")
    queries = materialize(met.mapInArrow(_floors(k, orders), "dim int, qids binary, qmatrix binary, floors binary"), "queries")
    spread = rows.select("id", "v").repartition(max(1, -(-n // BLOCK)), F.xxhash64("id"))
    blocks = spread.mapInArrow(_blocks(BLOCK, orders), shape).withColumn("block", F.monotonically_increasing_id())
    blocks = materialize(blocks, "blocks")
    # Every block of candidates gets every block of queries: (blocks x query blocks) rows.
    # A candidate block carries its matrix once; pairs travel as numbers and fetch it.
    places = blocks.select("block", F.col("dim").alias("_dim"))
    sent = queries.join(places, F.col("dim") == F.col("_dim")).select("block", "qids", "qmatrix", "floors")
    pairs = blocks.join(sent, "block").select("dim", "ids", "matrix", "qids", "qmatrix", "floors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim, ids, matrix, qids, qmatrix, floors = (batch.column(j)[r].as_py() for j in range(6))
                cid, qid = np.frombuffer(ids, np.int64), np.frombuffer(qids, np.int64)
                found = list(search(qid, _matrix(qmatrix, dim), cid, _matrix(matrix, dim), k, np.frombuffer(floors, np.float64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(qid, [len(f[1]) for f in found])),
                    pa.array(np.concatenate([f[1] for f in found])),
                    pa.array(np.concatenate([f[2] for f in found]).astype(np.int64)),
                ], names=["query_id", "id", "score"])

    best = pairs.mapInArrow(run, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
