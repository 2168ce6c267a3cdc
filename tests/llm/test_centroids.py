import hashlib
import math
import random

from pyspark.sql import functions as F

from shapelens.llm import centroids

VECTORS = "vec_id long, embedding array<double>, label int"


def plain(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min(range(len(cents)), key=lambda j: (far(v, cents[j]), j))
    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(nearest(v), []).append(v)
        cents = [[sum(x) // len(held[j]) for x in zip(*held[j])] if j in held else c for j, c in enumerate(cents)]
    found = [(i, nearest(v), far(v, cents[nearest(v)])) for i, v in kept]
    sums = {j: sum(d for _, n, d in found if n == j) for j in range(len(cents))}
    long = lambda v: v if v < 1 << 63 else None
    return sorted(((i, n, long(d), long(sums[n]), long(sum(sums.values())), hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest()) for i, n, d in found), key=repr)


def report(spark, rows, parts=3, **extra):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS).repartition(parts)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    got = centroids.cluster_report(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def vectors(n, seed=1, spread=1.0):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [x + r.gauss(0, 0.3) * spread for x in centres[i % 5]]) for i in range(n)]


def test_same_as_plain(spark):
    rows = vectors(300)
    assert report(spark, rows, id=4, cluster=2, distance=1, vector="x") == plain(rows)


def test_ties_and_copies(spark):
    """Vectors on a grid: many are equally far from two centroids, a third are copies of one."""
    r = random.Random(5)
    rows = [(i, [float(r.randint(-1, 1)) if d < 3 else 0.0 for d in range(64)]) for i in range(120)] + [(1000 + i, [1.0] + [0.0] * 63) for i in range(60)]
    rows += [(7, rows[7][1])] * 3
    assert report(spark, rows) == plain(rows)


def test_odd_rows_and_large_numbers(spark):
    rows = vectors(20) + [(100, None), (101, []), (102, [1.0] * 63), (103, [None] * 64), (104, [float("nan")] * 64), (105, [float("inf")] * 64),
                          (106, [1.0] * 65), (None, [0.5] * 64), (108, [3e9] * 64), (109, [-1e30] * 64), (110, [1e300] + [0.0] * 63)]
    assert report(spark, rows) == plain(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    assert report(spark, vectors(3)) == plain(vectors(3))
    assert report(spark, []) == []
