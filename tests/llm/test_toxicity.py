import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shapelens.llm import toxicity
from shapelens.llm.texts import part_of


def brute_segments(scores):
    """Maximal scoring subsequences by their recursive definition: the best segment, then what is left and right of it."""
    def best(lo, hi):
        top = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i, hi):
                total += scores[j]
                if total > 1e-9 and (top is None or total > top[0] + 1e-9 or (abs(total - top[0]) < 1e-9 and j + 1 - i < top[2] - top[1])):
                    top = (total, i, j + 1)
        if top is None:
            return []
        return best(lo, top[1]) + [(top[1], top[2], top[0])] + best(top[2], hi)

    return best(0, len(scores))


def test_segments_equal_the_definition():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(0, 18)
        scores = [(rng.choice([0.35, 1.27, 2.61, 0.83]) if rng.random() < 0.4 else -rng.choice([0.501, 0.113, 1.7])) + rng.random() / 100 for _ in range(n)]
        got = [(s, e, round(x, 6)) for s, e, x in toxicity.segments(np.array(scores))]
        assert got == [(s, e, round(x, 6)) for s, e, x in brute_segments(scores)]


def test_every_token_has_its_log_odds_under_the_prior():
    # kind, token, other documents of both halves, toxic documents of both halves
    rows = [("docs", b"", 80, 60, 20, 50), ("word", b"awful", 1, None, 9, None), ("family", b"awfu", 3, None, 12, None), ("word", b"of", 40, 7, 10, 9),
            ("word", b"rare", 2, None, None, None), ("word", b"other", None, None, None, 50)]
    model = toxicity._tables(pa.table(dict(zip(("kind", "token", "n00", "n01", "n10", "n11"), map(list, zip(*rows, strict=True)), strict=True))), (0,))
    odds = lambda share: math.log(share / (1 - share)) - math.log(0.2 / 0.8)
    family = (12 + 10 * 0.2) / 25
    assert model.words == pytest.approx({b"awful": odds((9 + 10 * family) / 20), b"of": 0.0, b"rare": odds(2 / 12)})
    got = model.scores([b"awfully", b"of", b"nowhere", b"awful", "äöü".encode()])  # a family, itself, neither, itself, three code points
    assert got == pytest.approx([odds(family) - toxicity.COST, -toxicity.COST, -toxicity.COST, model.words[b"awful"] - toxicity.COST, -toxicity.COST])


def test_lambda_and_k_are_found_again():
    rng = np.random.default_rng(4)
    tokens = rng.integers(50, 2000, 20_000)
    best = (np.log(0.03 * tokens) - np.log(rng.exponential(size=len(tokens)))) / 1.7  # the inverse of the distribution
    rate, spread = toxicity.extreme_value_fit(best, tokens)
    assert rate == pytest.approx(1.7, rel=0.02) and spread == pytest.approx(0.03, rel=0.1)
    assert toxicity.extreme_value_fit(np.zeros(0), np.zeros(0)) == (1.0, 1.0)


def test_sample_is_drawn_by_label(make, spark):
    docs = make([(i, f"text {i}") for i in range(300)] + [(0, f"again {i}") for i in range(50)])
    labels = docs.select("doc_id", (F.col("doc_id") % 30 == 0).cast("int").alias("toxic")).distinct()
    rows, stands_for = toxicity._sample(docs, labels, "doc_id", "text", (4, 9), 40)
    assert {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()} == {1: 10, 0: 30}
    assert stands_for == {1: 1.0, 0: 290 / 30}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = toxicity.toxicity_report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.02 * len(rows)


def test_labels_of_held_out_rows_do_not_matter(make, spark):
    docs = make([(i, f"w{i % 17} text of all kinds {'idiot scum' if i % 5 == 0 else 'fine'} end") for i in range(400)])
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    turned = labels.withColumn("toxic", F.when(part_of(F.col("doc_id"), 4, 2) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (sorted(toxicity.toxicity_report(docs, l).collect()) for l in (labels, turned))
    assert one == two
    assert all(r.predicted == (r.doc_id % 5 == 0) for r in one)


def test_odd_rows(odd, make, spark):
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (4, 0), (5, 0), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.toxicity_report(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    none = toxicity.toxicity_report(odd, labels.where("false")).collect()
    assert len({r.score for r in none}) == 1
    assert toxicity.toxicity_report(odd.where("false"), labels).count() == 0
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns
