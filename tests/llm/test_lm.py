import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shapelens.llm import lm
from shapelens.llm.gru import Gru


def test_base_and_counts_equal_plain_code(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in lm.lm_report(docs).collect()}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {r.doc_id: re.findall("[^\x20\x09-\x0D]+", r.text.translate(low)) + [None] for r in docs.collect()}
    counts = Counter()
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(t)
    total, kinds = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(t), sum(counts[w] > 0 for w in t), total, zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in t))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score > r.base_score for r in held) > 0.95 * len(held)
    assert all(r.score < 0 for r in held)


def some_model(random):
    shares = np.zeros((lm.CLASSES, lm.HEADS, 2))
    shares[:, :, 0] = random.integers(0, 50, shares.shape[:2])
    classes = lm.Classes(np.arange(1, 30).astype(np.uint64), np.arange(1, 9))
    return lm.Model(classes, shares)


def test_state_runs_through_whole_documents():
    random = np.random.default_rng(3)
    sizes = [1, 40, 7, 300]
    model = some_model(random)
    documents = [lm.Tokens(random.integers(1, 60, n).astype(np.uint64), random.integers(1, 12, n), random.integers(0, lm.HEADS, n), np.array([0, n])) for n in sizes]
    coded = [(model.classes.of(d), d.heads) for d in documents]
    before = model.weights()
    model.learn(coded, 0, 1, streams=2)
    assert np.abs(model.weights() - before).max() > 1e-3 and (model.with_weights(model.weights()).weights() == model.weights()).all()
    got = model.score(np.concatenate([c for c, _ in coded]), np.concatenate([g for _, g in coded]), np.cumsum([0, *sizes]))
    want = []
    for kinds, heads in coded:
        h, last = np.zeros((1, lm.SIZE), np.float32), lm.CLASSES
        for k, g in zip(kinds, heads, strict=True):
            h = model.gru.step(np.array([last]), h)
            logits = (h @ model.p["out"] + model.p["bias"])[0].astype(float)
            value = logits[k] - np.log(np.exp(logits).sum())
            if k >= lm.SINGLES:
                inner = (h[0] @ model.p["inner"][k] + model.p["inner_bias"][k]).astype(float)
                value += inner[g] - np.log(np.exp(inner).sum())
            want.append(value)
            last = k
    assert abs(got - np.array(want)).max() < 1e-3


def test_probabilities_of_all_tokens_add_up():
    """After any state: over every known token, and what each group keeps for unseen ones."""
    random = np.random.default_rng(1)
    vocabulary = [(k, g, int(c)) for k in range(lm.CLASSES) for g in range(lm.HEADS) if k >= lm.SINGLES for c in random.integers(1, 4, random.integers(0, 4))]
    vocabulary += [(k, 0, 40) for k in range(lm.SINGLES)]
    kinds, heads, counts = (np.array(x) for x in zip(*vocabulary))
    shares = np.zeros((lm.CLASSES, lm.HEADS, 2))
    np.add.at(shares, (kinds, heads), np.stack([counts, counts == 1], 1))
    model = lm.Model(lm.Classes(np.zeros(0, np.uint64), np.zeros(0, np.int64)), shares)
    model = model.with_weights(model.weights() + random.normal(0, 0.5, model.weights().shape))
    state = random.normal(0, 1, (1, lm.SIZE)).astype(np.float32)

    def mass(kinds, heads, counts):
        log = model.log_choices(np.repeat(state, len(kinds), 0), kinds, heads).astype(float) + model.log_share(kinds, heads, counts)
        return np.exp(log).sum()

    rest = np.array([(k, g) for k in range(lm.SINGLES, lm.CLASSES) for g in range(lm.HEADS)])
    assert mass(kinds, heads, counts) + mass(rest[:, 0], rest[:, 1], np.zeros(len(rest), int)) == pytest.approx(1, abs=1e-4)


def test_what_is_learnt_from_grows(spark):
    """Classes come from all training rows, and so do more documents as there are more."""
    docs = spark.range(4000).selectExpr("id", "concat('common w', id, ' thing', id % 7) as text", "id % 7 <> 2 as learn")
    counts = docs.where("learn").selectExpr("explode(split(text, ' ')) as word").groupBy("word").count()
    assert counts.where("word = 'common'").first()["count"] > lm.LEARN_LEAST
    got = lm.score_texts(docs, F.col("learn"), "id").collect()
    assert len(got) == 4000 and {r.train_tokens for r in got} == {4 * docs.where("learn").count()}
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_odd_rows(odd):
    rows = lm.lm_report(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1 and by[5].n_tokens == 120_001
    assert by[1].score == by[2].score and all(math.isfinite(r.score) for r in rows)
    assert by[None].held_out
    assert lm.lm_report(odd.where("false")).count() == 0
    only_held = lm.lm_report(odd.where("doc_id is null")).collect()
    assert [r.n_known for r in only_held] == [0] and math.isfinite(only_held[0].score)


def test_every_training_document_is_learnt_from(spark, monkeypatch):
    """Rounds together pass over all training documents, however many there are."""
    seen = spark.sparkContext.accumulator(0)
    inner = lm._pass

    def counting(model, turn):
        learn = inner(model, turn)

        def count(table):
            seen.add(len(table))
            return learn(table)

        return count

    monkeypatch.setattr(lm, "_pass", counting)
    monkeypatch.setattr(lm, "LEARN_LEAST", 20)
    docs = spark.range(400).selectExpr("id", "concat('common w', id) as text", "id % 4 <> 1 as learn")
    assert lm.score_texts(docs, F.col("learn"), "id").count() == 400
    assert seen.value == 300


def test_no_text_is_written_or_shuffled(spark, monkeypatch):
    """What goes to disk is a byte or two a token, wherever blocks are cut, and the same scores come back."""
    words = "concat_ws(' ', transform(sequence(1, 60), i -> concat('Common', pmod(hash(id, i), 9))), concat('w', id))"
    docs = spark.range(0, 600, 1, 3).selectExpr("if(id % 50 = 0, null, id) as id", f"{words} as text", "id % 4 <> 1 as learn")
    written, inner = [], lm.sized

    def keeping(df):
        written.append(inner(df))
        return written[-1]

    monkeypatch.setattr(lm, "sized", keeping)
    scored = lm.score_texts(docs, F.col("learn"), "id")
    assert not [t.columns for t in written if "text" in t.columns]
    assert "text#" not in scored._jdf.queryExecution().executedPlan().toString()
    packed = [t.agg(F.sum(F.octet_length(c))).first()[0] for t in written for c, kind in t.dtypes if kind == "binary"]
    assert len(packed) == 2 and max(packed) < 0.2 * docs.agg(F.sum(F.octet_length("text"))).first()[0]
    want = sorted(scored.collect(), key=str)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 20000)
    del written[:]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = sorted(lm.score_texts(docs, F.col("learn"), "id").collect(), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert written[0].select("block").distinct().count() == 12
    assert [(r.id, r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(r.id, r.n_tokens, r.n_known, r.train_tokens) for r in want]
    assert sorted(r.score for r in got) == pytest.approx(sorted(r.score for r in want), rel=1e-5)
    assert sorted(r.base_score for r in got) == pytest.approx(sorted(r.base_score for r in want))


def test_numbers_come_back_from_bytes():
    numbers = np.array([0, 127, 128, 16383, 16384, 2**21, 2**28 - 1, 2**31, 5])
    starts = np.array([0, 0, 3, 8, 9, 9])
    column = lm.pack(numbers, starts)
    assert [len(x.as_py()) for x in column] == [0, 4, 2 + 3 + 4 + 4 + 5, 1, 0]
    for got, want in zip(lm.unpack(column), (numbers, starts), strict=True):
        assert got.tolist() == want.tolist()
    cut, at = lm.unpack(column.slice(1, 2))
    assert cut.tolist() == numbers[:8].tolist() and at.tolist() == [0, 3, 8]
    classes, heads = (x.ravel() for x in np.meshgrid(np.arange(lm.CLASSES), np.arange(lm.HEADS)))
    kinds, groups = lm.choice_parts(lm.choice(classes, heads))
    assert (kinds == classes).all() and (groups == np.where(classes < lm.SINGLES, 0, heads)).all()


def test_passes_over_full_streams_equal_those_over_any():
    random = np.random.default_rng(5)
    gru = Gru(9, 4, random)
    x, h, back = random.integers(0, 9, (6, 5)), random.normal(0, 0.5, (5, 4)).astype(np.float32), random.normal(0, 1, (6, 5, 4)).astype(np.float32)
    want, kept = gru.forward(x, h, np.ones(x.shape, bool))
    got, kept_all = gru.forward_all(x, h)
    assert np.allclose(got, want, atol=1e-6)
    slopes = gru.backward(x, np.ones(x.shape, bool), kept, back)
    for k, g in gru.backward_all(x, kept_all, back).items():
        assert np.allclose(g, slopes[k], atol=1e-5), k


def test_slopes_are_those_of_the_loss_at_any_reach():
    random = np.random.default_rng(7)
    for scale, reaches in ((1, False), (60, True)):
        weight, bias = random.normal(0, scale, (4, 6)).astype(np.float32), random.normal(0, 1, 6).astype(np.float32)
        states, targets, share = random.uniform(-1, 1, (8, 4)).astype(np.float32), random.integers(0, 6, 8), random.uniform(0, 1, 8).astype(np.float32)
        level, far = lm._levelled(weight, bias)
        logits = (states @ weight + bias).astype(np.float64)
        odds = np.exp(logits - logits.max(1, keepdims=True))
        odds /= odds.sum(1, keepdims=True)
        want = (odds - np.eye(6)[targets]) * share[:, None]
        assert far == reaches and np.allclose(lm._slopes(states @ weight + level, targets, share, far), want, atol=1e-4)
        assert np.allclose(lm._log_chosen(states @ weight + level, targets, far), np.log(np.maximum(odds[np.arange(8), targets], 1e-300)), atol=1e-3)
