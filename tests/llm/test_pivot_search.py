import math
import random

import numpy as np
from pyspark.sql import functions as F

from shapelens.llm import pivot_search

VECTORS = "vec_id long, embedding array<double>"


def plain(rows, k=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(kept):
        if q is not None and q % 100 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for n, (i, w) in enumerate(kept) if n != at]
            for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda r: r[:3])[:k], 1):
                out.append((q, rank, i, -s if abs(s) < 1 << 63 else None))
    return sorted(out, key=repr)


def report(spark, rows, **extra):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return sorted((tuple(r) for r in pivot_search.search_report(df).select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def vectors(n, dims=16, seed=2):
    r = random.Random(seed)
    return [(i, [r.gauss(0, 1 + i % 3) for _ in range(dims)]) for i in range(n)]


def test_same_as_plain(spark):
    rows = vectors(700, 64)
    assert report(spark, rows, id=1, vector="v", far=2, copies=3, score=4) == plain(rows)


def test_ties_copies_and_repeated_queries(spark):
    rows = [(i, [float(i % 3), 1.0, 0.0]) for i in range(400)] + [(200, [2.0, 1.0, 0.0])] * 2 + [(5, [2.0, 1.0, 0.0])] * 40
    assert report(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = vectors(120, 8) + [(300, None), (400, [None, 1.0]), (500, [float("nan")]), (600, [float("-inf")] * 8), (700, []), (None, [1.0] * 8),
                              (800, [1.0] * 3), (900, [2.0] * 20), (1001, [1e9] * 8), (1100, [-4e12] * 8)]
    assert report(spark, rows) == plain(rows)


def test_few_rows_and_none(spark):
    assert report(spark, [(100, [1.0, 2.0]), (1, [3.0, 4.0])]) == [(100, 1, 1, 11534336)]
    assert report(spark, [(100, [1.0])]) == [] and report(spark, [(1, [1.0])]) == [] and report(spark, []) == []


def test_many_blocks_give_the_same(spark, monkeypatch):
    rows = [(100 * i, v) for i, v in vectors(60)]
    want = report(spark, rows)
    monkeypatch.setattr(pivot_search, "BLOCK", 150)
    assert report(spark, rows) == want == plain(rows)


def test_bounds_hold_and_rule_out(spark):
    """No score is above its bound, and in clustered data most candidates are never looked at."""
    r = np.random.default_rng(4)
    centres = r.normal(0, 300, (20, 64))
    data = np.floor(centres[np.arange(2000) % 20] + r.normal(0, 5, (2000, 64)))
    block = pivot_search.Block([0], [1], data[:50], pivot_search.distances(data[:50], data[20:52]), [None], [0])
    most = pivot_search._bounds(block, slice(0, 50), pivot_search.distances(data, data[20:52]))
    scores = data[:50] @ data.T
    assert (scores <= most).all()
    tenth = np.sort(scores, axis=1)[:, -10]
    assert (most >= tenth[:, None]).mean() < 0.4
