"""Exact top-k inner products with pivot tables.

Distances of every vector to many pivots are computed once.  For a query q and
a candidate x, |d(q,p) - d(x,p)| <= d(q,x) for every pivot p, and
<q,x> = (|q|^2 + |x|^2 - d(q,x)^2) / 2, so the largest of these differences
gives an upper bound of the score.  Pivots are rows themselves, so a query's
k-th best score among them is known beforehand; candidates whose bound lies
below it are never evaluated, the others in the order of their bounds until no
bound reaches the k-th best score.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import rows, save

#: Pivots of each vector length, spread over at most SAMPLE rows (those of the smallest id hashes); bounds of the first FIRST of them come first.
PIVOTS, SAMPLE, FIRST = 256, 2048, 64
#: Vectors in a block of candidates and of queries.
BLOCK, QUERY_BLOCK = 1024, 256
#: Candidates evaluated at first; then as many again as before.
CHUNK = 64


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x) as 64-bit integers.

    Rows whose id or vector is null, or whose vector is empty or holds a null or
    non-finite component, are left out.
    """
    x = F.transform(F.col(f"`{vector_col}`"), lambda e: e.cast("double"))
    good = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    v = F.transform("x", lambda e: F.floor(e * scale).cast("long"))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & good).select("vec_id", v.alias("v"))


def _blocks(size: int):
    """Rows (vec_id, v) of a partition to blocks (dim, ids, vectors) of vectors of one length."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)

        def flush(dim: int) -> pa.RecordBatch:
            own = held.pop(dim)
            ids, v = np.array([i for i, _ in own], np.int64), np.stack([v for _, v in own])
            return pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([v.tobytes()], pa.binary())})

        for batch in batches:
            column = batch.column("v")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
            for vec_id, v in zip(batch.column("vec_id").to_pylist(), np.split(flat, ends[:-1])):
                held[len(v)].append((vec_id, v))
                if len(held[len(v)]) >= size:
                    yield flush(len(v))
        for dim in list(held):
            yield flush(dim)

    return blocks


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, pivots = x.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * x @ pivots.T))


def spread(x: np.ndarray, n: int) -> np.ndarray:
    """Places of n rows of x, each the farthest from those before it."""
    far, out = np.full(len(x), np.inf), [0]
    while len(out) < min(n, len(x)):
        far = np.minimum(far, _distances(x, x[out[-1:]])[:, 0])
        out.append(int(np.argmax(far)))
    return np.array(out)


def _pivots(n: int):
    def chosen(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        x = np.array(table["v"].to_pylist(), np.int64)
        at = spread(x, n)
        return pa.table({"dim": table["dim"][:1], "p_ids": pa.array([table["vec_id"].to_numpy()[at].tobytes()], pa.binary()), "pivots": pa.array([x[at].tobytes()], pa.binary())})

    return chosen


def _matrix(blob: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(-1, dim)


def _gaps(k: int):
    """Blocks with their length's pivots to blocks with distances to the pivots, and for each vector its k-th best score among the pivots."""

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, vectors, p_ids, pivots in rows(batch, "dim", "ids", "vectors", "p_ids", "pivots", step=1):
                x, p = _matrix(vectors, dim), _matrix(pivots, dim)
                scores = x @ p.T
                lowest = np.iinfo(np.int64).min
                scores[np.frombuffer(ids, np.int64)[:, None] == np.frombuffer(p_ids, np.int64)] = lowest
                floor = np.sort(scores, 1)[:, -k] if len(p) >= k else np.full(len(x), lowest)
                columns = {"dim": pa.array([dim], pa.int32())} | {n: pa.array([a], pa.binary()) for n, a in (("ids", ids), ("vectors", vectors), ("gaps", _distances(x, p).astype(np.float32).tobytes()), ("floors", floor.tobytes()))}
                yield pa.RecordBatch.from_pydict(columns)

    return gaps


def best_of_block(ids, x, gaps, norm, qid, q, qgap, floor, k: int, widest: float | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """A block's candidates that may be among a query's k best: ids, scores, and how many candidates were evaluated.

    widest: the largest of gaps.  Bounds of the pivots after FIRST are worth
    their time only where the first ones leave half of the block or less.
    """
    slack = 4e-7 * max(float(gaps.max(initial=0) if widest is None else widest), float(qgap.max(initial=0)))  # distances are kept in single precision
    x, q = x.astype(float, copy=False), q.astype(float)  # whole numbers below 2**53
    square = (q**2).sum()

    def bounds(gaps, norm, first, last):
        low = np.maximum(0, np.abs(gaps[:, first:last] - qgap[first:last]).max(1, initial=0).astype(float) - slack)
        bound = (square + norm - low**2) / 2
        return bound + 1 + np.abs(bound) * 1e-9  # floating-point slack

    bound = bounds(gaps, norm, 0, FIRST)
    at = np.flatnonzero((bound >= floor) & (ids != qid))
    bound = bound[at]
    if gaps.shape[1] > FIRST and 0 < 2 * len(at) <= len(ids):
        bound = np.minimum(bound, bounds(gaps[at], norm[at], FIRST, None))
        at, bound = at[bound >= floor], bound[bound >= floor]
    order = np.argsort(-bound)
    at, bound = at[order], bound[order]
    scores, found, evaluated = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    while evaluated < len(at):
        if len(scores) >= k and bound[evaluated] < scores[k - 1]:
            break
        own = at[evaluated : evaluated + max(CHUNK, evaluated)]
        evaluated += len(own)
        scores, found = np.r_[scores, (x[own] @ q).astype(np.int64)], np.r_[found, ids[own]]
        top = np.lexsort((found, -scores))[:k]
        scores, found = scores[top], found[top]
    return found, scores, evaluated


def _best(k: int):
    """Block pairs to each query's k best of the block: (query_id, vec_id, score), and a row (query_id, null, evaluated) of the candidates evaluated."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, ids, vectors, gaps, q_ids, q_vectors, q_gaps, q_floors in rows(batch, "dim", "ids", "vectors", "gaps", "q_ids", "q_vectors", "q_gaps", "q_floors", step=1):
                ids, x, qids, q, floors = np.frombuffer(ids, np.int64), _matrix(vectors, dim), np.frombuffer(q_ids, np.int64), _matrix(q_vectors, dim), np.frombuffer(q_floors, np.int64)
                gaps, qgaps = np.frombuffer(gaps, np.float32).reshape(len(ids), -1), np.frombuffer(q_gaps, np.float32).reshape(len(qids), -1)
                x, gaps = x.astype(float), np.asfortranarray(gaps)  # a pivot's distances lie together
                norm, widest = (x**2).sum(1), float(gaps.max(initial=0))
                out = []
                for i in range(len(qids)):
                    found, scores, evaluated = best_of_block(ids, x, gaps, norm, qids[i], q[i], qgaps[i], floors[i], k, widest)
                    out += [(int(qids[i]), f, s) for f, s in zip(found.tolist(), scores.tolist())] + [(int(qids[i]), None, evaluated)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["query_id", "vec_id", "score"])

    return search


def candidates(vectors: DataFrame, is_query, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, vec_id, score): each query's best of every block; rows without a vec_id tell how many candidates of a block were evaluated."""
    table = save(vectors.withColumn("dim", F.size("v")))
    order = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = table.select("dim", "vec_id", "v", F.row_number().over(order).alias("place")).where(F.col("place") <= SAMPLE).drop("place")
    marks = save(sample.groupBy("dim").applyInArrow(_pivots(pivots), "dim int, p_ids binary, pivots binary"))
    blocks = lambda df, size: df.select("vec_id", "v").mapInArrow(_blocks(size), "dim int, ids binary, vectors binary").join(F.broadcast(marks), "dim").mapInArrow(_gaps(k), "dim int, ids binary, vectors binary, gaps binary, floors binary")
    held = save(blocks(table, BLOCK).select(F.monotonically_increasing_id().alias("block"), "*"))
    asked = blocks(table.where(is_query), QUERY_BLOCK).toDF("dim", "q_ids", "q_vectors", "q_gaps", "q_floors")
    # the stated query set meets each block of rows once: as many lanes as blocks, and each query block on every lane
    lanes = max(1, held.count())
    held = held.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)))
    asked = asked.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
    pairs = held.join(asked, ["dim", "lane"]).select("dim", "ids", "vectors", "gaps", "q_ids", "q_vectors", "q_gaps", "q_floors")
    return pairs.mapInArrow(_best(k), "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """Each query's k highest scores: query_id, rank, vec_id, score.

    vectors: the table of quantised(); is_query: a condition on vec_id.
    Candidates are all rows whose id is not the query's own; ties go to the
    smaller id, and fewer candidates give fewer rows.  Vectors meet those of
    their own length only.  Rows that repeat an id are each a candidate; as
    queries they share one ranking, in which a candidate may stand once for each.
    Scores are exact while they, and squared lengths, stay below 2**53.  An
    empty table gives an empty result.
    """
    best = candidates(vectors, is_query, k, pivots).where("vec_id is not null")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
