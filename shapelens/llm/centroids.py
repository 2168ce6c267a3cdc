"""Lloyd's clustering over integer vectors, assigning by a tournament of bisectors.

Vector x is nearer to centroid j than to i < j exactly when x . n > t with n = 2 (cj - ci) and t = |cj|^2 - |ci|^2. All
normals and thresholds are integers and made once a round. Of k centroids, k - 1 such sign tests leave one: the first
champion is centroid 0, the challenger j takes its place if the test is positive, and zero leaves the smaller number.
No distance is computed before the final assignment.

A round is one scan. Every task sums what it read by cluster and component; what is shuffled does not depend on the
number of vectors, and the driver holds k centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelens.llm.vectors import exact, integers, is_usable, longs, matrices
from shapelens.session import sized

#: Sums travel as digits of this base, so that no sum of any size overflows; COUNT stands for the number of vectors.
BASE_BITS, COUNT = 40, -1


class Bisectors:
    """Normals and thresholds of all pairs of centroids (lists of integers)."""

    def __init__(self, centroids: list[list[int]]) -> None:
        self.k = len(centroids)
        self.whole = np.array(centroids, dtype=object).reshape(self.k, -1)
        squares = [sum(v * v for v in c) for c in self.whole]
        self.normal = {(i, j): 2 * (self.whole[j] - self.whole[i]) for j in range(self.k) for i in range(j)}
        self.threshold = {(i, j): squares[j] - squares[i] for j in range(self.k) for i in range(j)}
        self.floats = self.whole.astype(np.float64) if self._small() else None
        self.float_normal = {p: n.astype(np.float64) for p, n in self.normal.items()} if self.floats is not None else {}

    def _small(self) -> bool:
        return exact(self.whole)

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid of each row, exact squared distance to it); floating point only where it is exact."""
        fast = self.floats is not None and exact(vectors)
        rows = vectors if fast else integers(vectors)
        normal = self.float_normal if fast else self.normal
        champion = np.zeros(len(rows), np.int64)
        for j in range(1, self.k):
            holders = champion.copy()
            for i in np.unique(holders):
                held = np.flatnonzero(holders == i)
                ahead = rows[held] @ normal[int(i), j] > self.threshold[int(i), j]
                champion[held[ahead.astype(bool)]] = j
        apart = rows - (self.floats if fast else self.whole)[champion]
        return champion, (apart * apart).sum(axis=1)


def _digits(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << BASE_BITS) - 1)))
        value >>= BASE_BITS
    return out


def _sums(batches: Iterable[pa.RecordBatch], column: str, bisectors: Bisectors) -> Iterator[pa.RecordBatch]:
    """Sums of a task's vectors by cluster and component, and their numbers."""
    k, dims = bisectors.whole.shape
    totals, counts = np.zeros((k, dims), dtype=object), [0] * k
    for _, vectors in matrices(batches, column):
        cluster, _ = bisectors.assign(vectors)
        fits = exact(vectors)
        for c in np.unique(cluster):
            own = vectors[cluster == c]
            counts[c] += len(own)
            # a slice's sums of exact components stay below 2**53
            totals[c] = totals[c] + (integers(own.sum(axis=0)) if fits else integers(own).sum(axis=0))
    rows = [(c, d, place, digit) for c in range(k) for d, v in [(COUNT, counts[c]), *enumerate(totals[c])] for place, digit in enumerate(_digits(v))]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))], names=["cluster", "dim", "place", "digit"])


def _assigned(batches: Iterable[pa.RecordBatch], column: str, id_column: str, bisectors: Bisectors) -> Iterator[pa.RecordBatch]:
    for rows, vectors in matrices(batches, column):
        cluster, distance = bisectors.assign(vectors)
        values = integers(distance)
        yield pa.RecordBatch.from_arrays(
            [rows.column(id_column), pa.array(cluster, pa.int32()), longs(values)], names=["id", "cluster", "distance"])


def first_centroids(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors whose `<seed>:<id>` has the smallest SHA-256, ascending; a null id counts as empty, repeated ids
    go on by their components. Bounded by k rows."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = kept.withColumn("_hash", F.sha2(text, 256)).orderBy("_hash", "vector").limit(k).select("vector").collect()
    return [[int(np.floor(np.float64(x) * 1024)) for x in row.vector] for row in rows]


def next_centroids(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: the exact floor of every component's mean; a centroid without vectors stays."""
    bisectors = Bisectors(centroids)
    sums = kept.select("vector").mapInArrow(lambda batches: _sums(batches, "vector", bisectors), "cluster int, dim int, place int, digit bigint")
    total: dict[tuple[int, int], int] = {}
    for r in sums.groupBy("cluster", "dim", "place").agg(F.sum("digit").alias("digit")).collect():  # k times components times digits
        total[r.cluster, r.dim] = total.get((r.cluster, r.dim), 0) + (r.digit << (BASE_BITS * r.place))
    return [[total.get((c, d), 0) // n for d in range(len(old))] if (n := total.get((c, COUNT), 0)) else old for c, old in enumerate(centroids)]


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, id_column: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """`(id, cluster, distance)` of each usable vector, and the final centroids as integers.

    Vectors that are null, hold null, NaN or infinite components or have other than `dims` components are left out;
    repeated rows each count; a null id is kept. With fewer than k vectors there are as many centroids; with none the
    result is empty. A distance beyond the range of long is null, though the assignment is exact.
    """
    kept = sized(vectors.where(F.size(column) == dims).where(is_usable(F.col(column))).select(F.col(id_column).alias("id"), F.col(column).alias("vector")))
    centroids = first_centroids(kept, k, seed)
    kind = kept.schema["id"].dataType.simpleString()
    if not centroids:
        return kept.selectExpr("id", "0 as cluster", "0L as distance"), []
    for _ in range(rounds):
        centroids = next_centroids(kept, centroids)
    bisectors = Bisectors(centroids)
    return kept.mapInArrow(lambda batches: _assigned(batches, "vector", "id", bisectors), f"id {kind}, cluster int, distance bigint"), centroids


def cluster_report(vectors: DataFrame) -> DataFrame:
    rows, centroids = cluster(vectors)
    rows = sized(rows)
    sums = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def of_cluster(values: list, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]), F.col("cluster") + 1)

    total = [int(sums.get(c) or 0) for c in range(len(centroids))]
    fits = lambda v: v if v < 1 << 63 else None
    return rows.select(
        F.col("id").alias("vec_id"), "cluster", "distance", of_cluster([fits(t) for t in total], "bigint").alias("cluster_inertia"),
        F.lit(fits(sum(total))).cast("bigint").alias("inertia"),
        of_cluster([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids], "string").alias("centroid_sha256"))
