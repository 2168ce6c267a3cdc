"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads runs of bytes between whitespace, with a space on both sides, forwards and backwards, and gives
every byte position a distribution over languages; longer runs are read in stretches of 62 bytes. A document's
distribution is the mean over all its positions. As no state crosses whitespace, each distinct run of a batch is
computed once, which changes no result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapelens.llm.gru import Adam, Gru
from shapelens.llm.texts import part_of, slices
from shapelens.session import sized

STRETCH = 62
#: Bounds of what is learnt from: documents, of all languages alike, and runs drawn from each.
SAMPLE_DOCS, SAMPLE_RUNS = 3000, 150
SIZE, STEPS, BATCH = 16, 700, 256
#: Runs whose labels a task remembers at most.
REMEMBERED = 200_000
_LETTER = re.compile(r"[^\W\d_]")


def runs_of(text: str | None) -> list[bytes]:
    """Runs of bytes between whitespace, cut into stretches."""
    out = text.encode("utf-8", "surrogatepass").split() if text else []
    if any(len(run) > STRETCH for run in out):
        out = [run[i: i + STRETCH] for run in out for i in range(0, len(run), STRETCH)]
    return out


def padded(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with a space on both sides, a column per run, and whether there is one."""
    lengths = np.array([len(r) for r in runs]) + 2
    steps = int(lengths.max())
    grid = np.frombuffer(b"".join((b" " + r).ljust(steps) for r in runs), np.uint8).reshape(len(runs), steps).T
    return grid, np.arange(steps)[:, None] < lengths


def _backwards(grid: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Index of the step that is read at each step from the end; padding stays in place."""
    steps, lengths = np.arange(len(grid))[:, None], real.sum(0)
    return np.where(real, lengths - 1 - steps, steps)


@dataclass
class Tagger:
    languages: list[str]
    ahead: Gru
    back: Gru
    out: dict[str, np.ndarray]

    def _logits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a @ self.out["a"] + b @ self.out["b"] + self.out["bias"]
        x -= x.max(-1, keepdims=True)
        np.exp(x, out=x)
        return x / x.sum(-1, keepdims=True)

    def labels(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each run the sum of its positions' distributions, and their number (the bytes of the run)."""
        sums = np.zeros((len(runs), len(self.languages)), np.float32)
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        for at in range(0, len(order), 4096):
            chosen = order[at: at + 4096]
            grid, real = padded([runs[i] for i in chosen])
            mirror = _backwards(grid, real)
            flipped = np.take_along_axis(grid, mirror, 0)
            h = np.zeros((len(chosen), self.ahead.size), np.float32)
            a, b = np.empty((*grid.shape, self.ahead.size), np.float32), np.empty((*grid.shape, self.ahead.size), np.float32)
            g = h
            for t in range(len(grid)):
                a[t] = h = self.ahead.step(grid[t], h)
                b[t] = g = self.back.step(flipped[t], g)
            b = np.take_along_axis(b, mirror[:, :, None], 0)
            inner = real.copy()
            inner[0] = False
            inner[real.sum(0) - 1, np.arange(len(chosen))] = False
            labels = self._logits(a, b)
            sums[chosen] = (labels * inner[:, :, None]).sum(0)
        return sums, np.array([len(r) for r in runs], np.int64)


def train_tagger(runs: list[bytes], languages: list[str], steps: int = STEPS) -> Tagger | None:
    """Backpropagation through time over all positions of drawn runs; languages are drawn equally often."""
    names = sorted(set(languages))
    if not names:
        return None
    random = np.random.default_rng(7)
    ahead, back = Gru(256, SIZE, random), Gru(256, SIZE, random)
    out = {"a": random.normal(0, 0.1, (SIZE, len(names))).astype(np.float32), "b": random.normal(0, 0.1, (SIZE, len(names))).astype(np.float32),
           "bias": np.zeros(len(names), np.float32)}
    tagger = Tagger(names, ahead, back, out)
    label = np.array([names.index(x) for x in languages])
    by = [np.flatnonzero(label == i) for i in range(len(names))]
    adam = [Adam(), Adam(), Adam()]
    for step in range(steps if len(names) > 1 else 0):
        for a in adam:
            a.rate = 0.01 * (1 - 0.9 * step / steps)
        which = random.integers(len(names), size=BATCH)
        chosen = [int(random.choice(by[i])) for i in which]
        grid, real = padded([runs[i] for i in chosen])
        mirror = _backwards(grid, real)
        flipped = np.take_along_axis(grid, mirror, 0)
        start = np.zeros((BATCH, SIZE), np.float32)
        a, kept_a = ahead.forward(grid, start, real)
        b, kept_b = back.forward(flipped, start, real)
        b_here = np.take_along_axis(b, mirror[:, :, None], 0)
        error = tagger._logits(a, b_here)
        error[:, np.arange(BATCH), which] -= 1
        error *= real[:, :, None] / np.float32(real.sum())
        d_b = np.take_along_axis(error @ out["b"].T, mirror[:, :, None], 0)
        grads = {"a": np.tensordot(a, error, ((0, 1), (0, 1))), "b": np.tensordot(b_here, error, ((0, 1), (0, 1))), "bias": error.sum((0, 1))}
        adam[0](ahead.p, ahead.backward(grid, real, kept_a, error @ out["a"].T))
        adam[1](back.p, back.backward(flipped, real, kept_b, d_b))
        adam[2](out, grads)
    return tagger


def _sample(docs: DataFrame, id_column: str, text: str, lang: str, fold: tuple[int, int], most: int) -> DataFrame:
    """order, lang, text of at most `most` documents.

    Languages take turns, each by the hash of its ids, until all are used or the sample is full: a language with few
    documents gives all of them, at whatever share of the table. Of rows with one id and language the least text counts.
    Languages are counted first; then only ids whose hash is so low that about four times as many as can be used
    remain are ranked.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(id_column).isNotNull() & (part_of(F.col(id_column), *fold) != fold[1]))
    rows = known.select(F.col(id_column).alias("id"), F.col(lang).alias("lang"), F.xxhash64(id_column).alias("order"), F.col(text).alias("text"))
    # Distinct ids, estimated: a repeated id counts once. The hash decides on whole ids, so rows of one id go together.
    sizes = sized(rows.groupBy("lang").agg(F.approx_count_distinct("id", 0.02).alias("n")))
    low = F.col("order").cast("double") / 2.0**64 + 0.5 < 4.0 * most / F.col("n")
    ids = rows.select("id", "lang", "order").join(sizes, "lang").where(low).groupBy("lang", "id", "order").agg(F.lit(1).alias("one")).drop("one")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("order", "id"))
    chosen = sized(ids.withColumn("turn", turn).where(F.col("turn") <= most).orderBy("turn", "order", "id", "lang").limit(most))
    found = rows.join(F.broadcast(chosen.select("id", "lang")), ["id", "lang"])  # at most `most` rows
    return found.groupBy("id", "lang", "order").agg(F.min("text").alias("text")).select("order", "lang", "text")


def fit_languages(docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, held_out: int = 0,
                  sample: int = SAMPLE_DOCS) -> Tagger | None:
    """Learn from text and language of at most `sample` documents outside of the held-out fold; None without any."""
    rows = _sample(docs, id_column, text, lang, (folds, held_out), sample)

    def draw(batches):
        for part in slices(batches, "text", 4 << 20):
            runs, languages = [], []
            for order, name, body in zip(*(part.column(c).to_pylist() for c in ("order", "lang", "text")), strict=True):
                all_runs = runs_of(body)
                picked = np.random.default_rng(abs(order)).permutation(len(all_runs))[:SAMPLE_RUNS]
                runs += [all_runs[i] for i in picked]
                languages += [name] * len(picked)
            yield pa.RecordBatch.from_arrays([pa.array(languages, pa.string()), pa.array(runs, pa.binary())], names=["lang", "run"])

    found = rows.mapInArrow(draw, "lang string, run binary").toPandas().sort_values(["lang", "run"])
    return train_tagger([bytes(r) for r in found["run"]], found["lang"].tolist())


def label_languages(docs: DataFrame, tagger: Tagger | None, keep: list[str], text: str = "text") -> DataFrame:
    """The `keep` columns with `lang_pred` and `score`, the mean probability of that language over all positions.

    `und` with score 0 for texts that are null or have no letter, and for all if nothing could be learnt; repeated
    rows are labelled one by one; an empty table gives an empty table; other columns are left out unless kept.
    """
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(k).alias(n) for n, k in zip(names, keep, strict=True)], F.col(text).alias("body"))
    types = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)

    def run(batches):
        known: dict[bytes, int] = {}
        sums, lengths = np.zeros((0, 0), np.float32), np.zeros(0, np.int64)
        for part in slices(batches, "body", 2 << 20):
            labels, scores = [], []
            bodies = part.column("body").to_pylist()
            lists = [runs_of(b) if tagger and b and _LETTER.search(b) else [] for b in bodies]
            if len(known) > REMEMBERED:
                known.clear()
            fresh = []
            for runs in lists:
                for run in runs:
                    if run not in known:
                        known[run] = len(known)
                        fresh.append(run)
            if fresh:
                s, n = tagger.labels(fresh)
                first = len(known) == len(fresh)
                sums, lengths = (s, n) if first else (np.concatenate([sums, s]), np.concatenate([lengths, n]))
            for runs in lists:
                if not runs:
                    labels.append("und")
                    scores.append(0.0)
                    continue
                at = np.fromiter(map(known.__getitem__, runs), np.int64, len(runs))
                mean = sums[at].sum(0, dtype=np.float64) / lengths[at].sum()
                best = int(mean.argmax())
                labels.append(tagger.languages[best])
                scores.append(min(1.0, float(mean[best])))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in names), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    out = rows.mapInArrow(run, f"{types}, lang_pred string, score double")
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keep, strict=True)], "lang_pred", "score")


def language_report(docs: DataFrame) -> DataFrame:
    tagger = fit_languages(docs)
    return label_languages(docs, tagger, ["doc_id"]).select("doc_id", (part_of(F.col("doc_id"), 5, 0) == 0).alias("held_out"), "lang_pred", "score")
