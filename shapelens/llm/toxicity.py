"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

Every token has a score: its log-odds between toxic and other labelled documents under a Dirichlet prior, less a cost
that makes an average token score below zero. All maximal segments of a text come from one linear scan (Ruzzo and
Tompa). Among other documents the best segment of n tokens exceeds S with probability 1 - exp(-K n exp(-lambda S))
(Karlin and Altschul); lambda and K are fitted by maximum likelihood to the best segments of other documents that the
scores were not learnt from. What the significant segments of a document exceed log(K n) by is summed and turned into
a probability by a logistic curve.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapelens.llm.texts import packed, part_of, slices, words_of
from shapelens.session import sized

#: Labelled documents that are learnt from at most, half of them toxic if there are as many: those of the lowest hash.
SAMPLE = 20_000
#: First code points of a word that stand for its family.
PREFIX = 4
#: Documents that the Dirichlet prior adds to those that hold a token, shared out as in its family, and to those that hold
#: a family, shared out as toxic and other documents are.
PRIOR = 10.0
#: What each token costs.
COST = 0.5


def family_of(word: bytes) -> bytes | None:
    """The first code points of a word that has as many."""
    if len(word) < PREFIX:
        return None
    start = word.decode("utf-8", "surrogatepass")[:PREFIX]
    return start.encode("utf-8", "surrogatepass") if len(start) == PREFIX else None


@dataclass
class Model:
    words: dict[bytes, float] = field(default_factory=dict)
    families: dict[bytes, float] = field(default_factory=dict)
    cost: float = COST
    rate: float = 1.0      # lambda
    spread: float = 1.0    # K
    curve: tuple[float, ...] = (0.0, 0.0, 0.0)

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Score of every token: its own, its family's where it was not seen in two documents, or zero; less the cost."""
        get, family = self.words.get, self.families.get
        odds = (family(family_of(word), 0.0) if (score := get(word)) is None else score for word in words)
        return np.fromiter(odds, float, len(words)) - self.cost


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, end, score) of tokens with these scores.

    Ruzzo and Tompa: a list of disjoint candidates, each with the sum before and after it; a new one is joined with
    the nearest candidate that starts lower, if it ends higher than that one.
    """
    out: list[tuple[int, int, float, float]] = []
    sums = np.cumsum(scores)
    positive = np.flatnonzero(scores > 0)
    for at, score, high in zip(positive.tolist(), scores[positive].tolist(), sums[positive].tolist(), strict=True):
        start, end, low = at, at + 1, high - score
        while True:
            k = len(out) - 1
            while k >= 0 and out[k][2] >= low:
                k -= 1
            if k < 0 or out[k][3] >= high:
                break
            start, low = out[k][0], out[k][2]
            del out[k:]
        out.append((start, end, low, high))
    return [(s, e, high - low) for s, e, low, high in out]


def best_segment(model: Model, words: list[bytes]) -> tuple[float, int]:
    """Score of the best segment (zero if there is none) and the number of tokens."""
    return max((score for _, _, score in segments(model.scores(words))), default=0.0), len(words)


def evidence(model: Model, words: list[bytes]) -> tuple[float, int, list[tuple[int, int, float]]]:
    """Summed excess of the significant segments, their number, and the segments with their excess."""
    if not words:
        return 0.0, 0, []
    chance = math.log(max(model.spread * len(words), 1e-9))
    passages = [(s, e, model.rate * score - chance) for s, e, score in segments(model.scores(words))]
    passages = [p for p in passages if p[2] > 0]
    return sum(p[2] for p in passages), len(passages), passages


def probability(model: Model, total: float, n: int) -> float:
    a, b, c = model.curve
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, a + b * math.log1p(total) + c * math.log1p(n)))))


def extreme_value_fit(best: np.ndarray, tokens: np.ndarray) -> tuple[float, float]:
    """Lambda and K of largest likelihood for the best segments of documents of so many tokens."""
    best, tokens = best[tokens > 0], tokens[tokens > 0].astype(float)
    if len(best) < 2 or best.max() <= best.min():
        return 1.0, 1.0
    low, high, least = 1e-3, 50.0, best.min()
    for _ in range(60):
        rate = (low + high) / 2
        weight = tokens * np.exp(-rate * (best - least))
        low, high = (rate, high) if 1 / rate - best.mean() + (best * weight).sum() / weight.sum() > 0 else (low, rate)
    return low, float(len(best) / (tokens * np.exp(-low * best)).sum())


def _tables(counts: pa.Table, halves: tuple[int, ...]) -> Model:
    """Scores from the counts of some halves of the sample: kind, token, and n<label><half>, the documents that hold it."""
    y0, y1 = (sum(pc.fill_null(counts[f"n{label}{half}"], 0).to_numpy().astype(float) for half in halves) for label in (0, 1))

    def of(kind: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        here = pc.equal(counts["kind"], kind).to_numpy() & (y0 + y1 > 0)
        return counts["token"].filter(pa.array(here)).to_pylist(), y0[here], y1[here]

    _, clean, bad = of("docs")
    model = Model()
    if clean.sum() and bad.sum():
        toxic = bad.sum() / (bad.sum() + clean.sum())

        def odds(share: np.ndarray) -> list[float]:
            return (np.log(share / (1 - share)) - math.log(toxic / (1 - toxic))).tolist()

        families, f0, f1 = of("family")
        share = (f1 + PRIOR * toxic) / (f0 + f1 + PRIOR)
        model.families = dict(zip(families, odds(share), strict=True))
        of_family = dict(zip(families, share.tolist(), strict=True))
        words, w0, w1 = of("word")
        prior = np.fromiter((of_family.get(family_of(w), toxic) for w in words), float, len(words))
        model.words = dict(zip(words, odds((w1 + PRIOR * prior) / (w0 + w1 + PRIOR)), strict=True))
    return model


def _counts(sample: DataFrame) -> pa.Table:
    """kind, token, and documents by label and half (n00 to n11); tokens that a single document holds are left to their family."""
    def run(batches):
        seen: Counter = Counter()
        for part in slices(batches, "text", 4 << 20):
            for text, label, half in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "half")), strict=True):
                words = set(words_of(text))
                seen.update(("word", w, label, half) for w in words)
                seen.update(("family", f, label, half) for f in {family_of(w) for w in words} if f)
                seen["docs", b"", label, half] += 1
            if len(seen) > 400_000:
                yield _batch(seen)
                seen.clear()
        if seen:
            yield _batch(seen)

    def _batch(seen):
        kinds, tokens, labels, halves = zip(*seen, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(tokens, pa.binary()), pa.array(labels, pa.int32()), pa.array(halves, pa.int32()), pa.array(list(seen.values()), pa.int64())],
            names=["kind", "token", "toxic", "half", "n"])

    counted = sample.mapInArrow(run, "kind string, token binary, toxic int, half int, n long")
    wide = counted.groupBy("kind", "token").agg(
        *[F.sum(F.when((F.col("toxic") == t) & (F.col("half") == h), F.col("n"))).alias(f"n{t}{h}") for t in (0, 1) for h in (0, 1)])
    held = sum((F.coalesce(f"n{t}{h}", F.lit(0)) for t in (0, 1) for h in (0, 1)), F.lit(0))
    return wide.where((F.col("kind") == "docs") | (held >= 2)).toArrow()


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-2) -> tuple[float, ...]:
    """Newton steps for a logistic curve of weighted rows with a small penalty on the slopes."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _sample(docs: DataFrame, labels: DataFrame, id_column: str, text: str, part: tuple[int, int], most: int) -> tuple[DataFrame, dict[int, float]]:
    """Texts, labels and halves of at most `most` labelled documents, and how many documents each one stands for by label.

    Each label gets half of the sample, and what the other one leaves. Of rows with one id the least text counts.
    """
    labelled = sized(
        labels.where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull() & (part_of(F.col(id_column), *part) != part[1]))
        .groupBy(F.col(id_column).alias("id")).agg((F.max("toxic") > 0).cast("int").alias("toxic")))
    # Only documents that exist and only their ids: the texts come in once the sample is known.
    there = sized(docs.select(F.col(id_column).alias("id")).join(labelled, "id").distinct().withColumn("order", F.xxhash64("id")))
    size = {t: 0 for t in (0, 1)} | {r["toxic"]: r["count"] for r in there.groupBy("toxic").count().collect()}
    share = {t: min(size[t], max(most // 2, most - size[1 - t])) for t in (0, 1)}
    first = [there.where(F.col("toxic") == t).orderBy("order", "id").limit(share[t]) for t in (0, 1)]
    chosen = sized(first[0].unionByName(first[1]))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "toxic", "order").agg(F.min("text").alias("text"))
    rows = sized(rows.select("text", "toxic", F.pmod(F.shiftright("order", 7), F.lit(2)).cast("int").alias("half")))
    return rows, {t: size[t] / share[t] for t in (0, 1) if share[t]}


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", folds: int = 4, held_out: int = 2,
                 sample: int = SAMPLE) -> Model:
    """Learn from labelled documents outside of the held-out fold, at most `sample` of them.

    Word scores come from one half, lambda, K and the curve from the other, and the other way round, so that nothing is
    fitted to what the scores were learnt from; the curve gives each document the weight of those it stands for.
    Documents with several labels are toxic if one says so. Without a toxic or without another document the model
    gives every text the share of toxic ones.
    """
    rows, stands_for = _sample(docs, labels, id_column, text, (folds, held_out), sample)
    counts = _counts(rows)
    halves = [_tables(counts, (1,)), _tables(counts, (0,))]  # each half is scored by the other one

    def scored(measure: Callable[[Model, list[bytes]], tuple]):
        """Two numbers of each document of the sample, by the model of the other half."""
        def run(batches):
            for part in slices(batches, "text", 4 << 20):
                got = [measure(halves[h], words_of(t))[:2] for t, h in zip(part.column("text").to_pylist(), part.column("half").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64()), part.column("toxic"), part.column("half")],
                    names=["x", "n", "toxic", "half"])

        return rows.mapInArrow(run, "x double, n long, toxic int, half int").toArrow().to_pandas()

    best = scored(best_segment)
    for half, learnt in enumerate(halves):
        other = best[(best["half"] == half) & (best["toxic"] == 0)]
        learnt.rate, learnt.spread = extreme_value_fit(other["x"].to_numpy(float), other["n"].to_numpy())
    model = _tables(counts, (0, 1))
    model.rate = (halves[0].rate + halves[1].rate) / 2
    model.spread = math.sqrt(halves[0].spread * halves[1].spread)
    seen = scored(evidence)
    y = seen["toxic"].to_numpy(float)
    weight = seen["toxic"].map(stands_for).to_numpy(float)
    if len(y) and 0 < y.mean() < 1:
        model.curve = _logistic(np.log1p(seen[["x", "n"]].to_numpy(float)), y, weight / weight.mean())
    else:
        share = float((y.sum() + 0.5) / (len(y) + 1))
        model.curve = (math.log(share / (1 - share)), 0.0, 0.0)
    return model


def score_toxicity(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The `keep` columns with `score` (0 to 1) and `passages`: (first word, end, excess) of each significant segment.

    Null and empty texts have no passages and the score of a text without one; repeated rows are scored one by one;
    an empty table gives an empty table; other columns are left out unless named in `keep`.
    """
    names = [f"k{i}" for i in range(len(keep))]
    passage = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("excess", T.DoubleType())])
    rows = docs.select(*[F.col(k).alias(n) for n, k in zip(names, keep, strict=True)], F.col(text).alias("body"))
    schema = T.StructType([*(T.StructField(n, rows.schema[n].dataType) for n in names), T.StructField("score", T.DoubleType()), T.StructField("passages", T.ArrayType(passage))])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("excess", pa.float64())]))

    def run(batches):
        for part in slices(batches, "body", 4 << 20):
            found = [evidence(model, words_of(t)) for t in part.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in names), pa.array([probability(model, f[0], f[1]) for f in found], pa.float64()),
                 pa.array([[{"start": s, "end": e, "excess": x} for s, e, x in f[2]] for f in found], arrow)],
                names=[*names, "score", "passages"])

    scored = rows.mapInArrow(run, schema)
    return scored.select(*[F.col(n).alias(k) for n, k in zip(names, keep, strict=True)], "score", "passages")


THRESHOLD = 0.3


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit_toxicity(docs, labels)
    return score_toxicity(docs, model, ["doc_id"]).select(
        "doc_id", (part_of(F.col("doc_id"), 4, 2) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that are less likely toxic than the threshold; columns as they were."""
    model = fit_toxicity(docs, labels)
    return score_toxicity(packed(docs), model, ["row"]).where(F.col("score") < THRESHOLD).select("row.*")
