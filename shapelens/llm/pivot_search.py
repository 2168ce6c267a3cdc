"""Exact top-k inner products of many queries, with candidates ruled out by a table of distances to pivots.

For any pivot p, |d(q, p) - d(x, p)| <= d(q, x); the largest such difference over all pivots bounds the distance from
below, and with q . x = (|q|^2 + |x|^2 - d(q, x)^2) / 2 the score from above. The origin is one of the pivots, which
gives Cauchy-Schwarz. A query looks at candidates in the order of their bounds and stops when none that is left can
reach the score it holds at rank k; only scores looked at are computed, and those exactly.

The distances of every vector to the pivots are computed once and written beside it. Queries come in blocks of bounded
size; a block goes to all tasks, each reads its vectors once and gives out k candidates a query. Pivots are vectors of
the table, so their own scores bound rank k before anything is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapelens.llm.vectors import exact, integers, is_usable, matrices
from shapelens.session import shared_dir, sized

PIVOTS = 32
#: Components of all queries of a block, which the driver and every task hold.
BLOCK = 1 << 20
TOGETHER = 64
#: Share of |q|^2 + |x|^2 that covers the rounding of stored distances many times over.
SLACK = 1e-5
_LIMIT = 10**38 - 1


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, max(0, width - matrix.shape[1]))))


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to the pivots and, last, to the origin."""
    width = max(vectors.shape[1], pivots.shape[1])
    v, p = widened(vectors, width), widened(pivots, width)
    out = np.empty((len(v), len(p) + 1), np.float32)
    with np.errstate(all="ignore"):  # what overflows rules nothing out
        for i, pivot in enumerate(p):
            out[:, i] = np.sqrt(((v - pivot) ** 2).sum(axis=1))
        out[:, -1] = np.sqrt((v * v).sum(axis=1))
    return out


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products; a shorter side counts as filled up with zeros."""
    width = min(vectors.shape[1], len(query))
    v, q = vectors[:, :width], query[:width]
    return v @ q if exact(v, q) else integers(v) @ integers(q)


def _table(batches: Iterable[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for rows, vectors in matrices(batches, "vector"):
        found = distances(vectors, pivots)
        offsets = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
        far = pa.ListArray.from_arrays(offsets, pa.array(found.ravel(), pa.float32()))
        yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("vector"), far], names=["id", "vector", "far"])


@dataclass
class Block:
    """Queries with their own pivot distances, squared lengths and scores, and a score that rank k has at least."""

    ids: list
    copies: list[int]
    vectors: np.ndarray
    far: np.ndarray
    floor: list
    own: list


def query_block(table: pa.Table, pivots: np.ndarray, k: int) -> Block:
    ids, copies, parts = [], [], []
    for rows, vectors in matrices(table.combine_chunks().to_batches(), "vector"):
        ids += rows.column("id").to_pylist()
        copies += rows.column("copies").to_pylist()
        parts.append(vectors)
    width = max((p.shape[1] for p in parts), default=0)
    vectors = np.concatenate([widened(p, width) for p in parts])
    near = [sorted(products(pivots, q), reverse=True) for q in vectors]
    floor = [s[k - 1] if len(s) >= k else None for s in near]
    own = [products(q[None, :], q)[0] for q in vectors]
    return Block(ids, copies, vectors, distances(vectors, pivots), floor, own)


def _bounds(block: Block, of: slice, far: np.ndarray) -> np.ndarray:
    """What the scores of some queries with all vectors of a slice can be at most."""
    with np.errstate(all="ignore"):
        apart = np.zeros((len(block.far[of]), len(far)), np.float32)
        step = np.empty_like(apart)
        for p in range(far.shape[1]):
            np.subtract(block.far[of, p, None], far[None, :, p], out=step)
            np.maximum(apart, np.abs(step, out=step), out=apart)
        squares = block.far[of, -1, None].astype(np.float64) ** 2 + far[None, :, -1].astype(np.float64) ** 2
        most = (squares - apart.astype(np.float64) ** 2) / 2 + SLACK * squares + 1
    return np.where(np.isnan(most), np.inf, most)


def _best(batches: Iterable[pa.RecordBatch], block: Block, k: int) -> Iterator[pa.RecordBatch]:
    """The k best candidates of each query among a task's vectors, ties to the smaller id, null ids last."""
    found: list[list] = [[] for _ in block.ids]
    least = list(block.floor)
    for rows, vectors in matrices(batches, "vector"):
        # in the order of ids, so that a stable sort by score breaks ties
        order = pc.sort_indices(rows.column("id"), null_placement="at_end").to_numpy()
        ids, vectors = rows.column("id").take(pa.array(order)).to_pylist(), vectors[order]
        flat = rows.column("far").flatten().to_numpy(zero_copy_only=False)
        far = flat.reshape(len(order), -1)[order]
        for start in range(0, len(block.ids), TOGETHER):
            most = _bounds(block, slice(start, start + TOGETHER), far)
            for q in range(start, min(start + TOGETHER, len(block.ids))):
                _look(q, most[q - start], vectors, ids, block, found, least, k)
    rows_out = [(q, s, i) for q, best in enumerate(found) for s, _, i in best]
    yield pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows_out], pa.int32()), pa.array([block.ids[r[0]] for r in rows_out], pa.int64()),
        pa.array([block.copies[r[0]] for r in rows_out], pa.int64()), pa.array([r[2] for r in rows_out], pa.int64()),
        pa.array([Decimal(max(-_LIMIT, min(_LIMIT, int(r[1])))) for r in rows_out], pa.decimal128(38, 0)),
        pa.array([r[2] == block.ids[r[0]] and r[1] == block.own[r[0]] for r in rows_out], pa.bool_()),
    ], names=["query", "query_id", "copies", "id", "score", "own"])


def _look(q: int, most: np.ndarray, vectors: np.ndarray, ids: list, block: Block, found: list[list], least: list, k: int) -> None:
    """Evaluate one query's candidates by falling bound, until no bound reaches what rank k already has."""
    rest = np.arange(len(most)) if least[q] is None else np.flatnonzero(most >= float(least[q]))
    take = 8 * k
    while len(rest):
        if len(rest) > take:
            cut = np.argpartition(-most[rest], take)
            now, rest = np.sort(rest[cut[:take]]), rest[cut[take:]]
        else:
            now, rest = np.sort(rest), rest[:0]
        scores = products(vectors[now], block.vectors[q])
        if least[q] is not None:
            high = np.flatnonzero(np.asarray(scores >= least[q], bool))
            now, scores = now[high], scores[high]
        if len(now):
            top = np.argsort(-scores, kind="stable")[:k]
            news = [(scores[t], (ids[now[t]] is None, ids[now[t]]), ids[now[t]]) for t in top]
            found[q] = sorted(found[q] + news, key=lambda r: (-r[0], r[1][0], r[1][1] or 0))[:k]
            if len(found[q]) == k and (least[q] is None or found[q][-1][0] > least[q]):
                least[q] = found[q][-1][0]
            rest = rest if least[q] is None else rest[most[rest] >= float(least[q])]
        take *= 8


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, pivots: int = PIVOTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """`(query_id, rank, id, score)`: the k highest integer inner products of each row whose id is divisible by `every`.

    Candidates are all rows but the query's own; ties go to the smaller id, null ids (which are candidates, but no
    queries) last; fewer candidates give fewer rows. Vectors that are null or hold null, NaN or infinite components
    take no part. A repeated row is a candidate each time, and a query each time, with the same result. Of vectors
    unlike in length the shorter counts as filled up with zeros. A score beyond long is null, beyond 38 digits tied.
    """
    spark = vectors.sparkSession
    usable = vectors.where(is_usable(F.col(column))).select(F.col(id_column).cast("bigint").alias("id"), F.col(column).alias("vector"))
    chosen = usable.orderBy(F.xxhash64("id", "vector"), "id", "vector").limit(pivots).select("vector").toArrow()
    parts = [m for _, m in matrices(chosen.combine_chunks().to_batches(), "vector")]
    width = max((p.shape[1] for p in parts), default=0)
    at = np.concatenate([widened(p, width) for p in parts]) if parts else np.zeros((0, 0))
    kind = usable.schema["vector"].dataType.simpleString()
    table = sized(usable.mapInArrow(lambda batches: _table(batches, at), f"id bigint, vector {kind}, far array<float>"))
    queries = sized(table.where(F.col("id") % every == 0).groupBy("id", "vector").agg(F.count("*").alias("copies")))
    components = queries.agg(F.sum(F.size("vector") + 1)).first()[0] or 0
    blocks, root = -(-components // BLOCK), f"{shared_dir(spark)}/top-{uuid.uuid4().hex}"
    # one candidate more, as the query's own row may be among them
    by_rank = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    for number in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)) == number).toArrow()
        if not own.num_rows:
            continue
        block = spark.sparkContext.broadcast(query_block(own, at, k + 1))
        best = table.mapInArrow(lambda batches, b=block: _best(batches, b.value, k + 1), "query int, query_id bigint, copies bigint, id bigint, score decimal(38,0), own boolean")
        ranked = best.withColumn("n", F.row_number().over(by_rank)).where(F.col("n") <= k + 1)
        ranked = ranked.withColumn("seen", F.sum(F.col("own").cast("int")).over(Window.partitionBy("query").orderBy("n")))
        others = ranked.where("not (own and seen = 1)").withColumn("rank", F.col("n") - F.least("seen", F.lit(1))).where(F.col("rank") <= k)
        others.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
            "query_id", F.col("rank").cast("int").alias("rank"), "id", F.col("score").try_cast("bigint").alias("score")).write.parquet(f"{root}/block={number}")
        block.unpersist()
    if not components:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    return spark.read.parquet(root).select("query_id", "rank", "id", "score")


def search_report(vectors: DataFrame) -> DataFrame:
    return top_k(vectors).withColumnRenamed("id", "vec_id")
