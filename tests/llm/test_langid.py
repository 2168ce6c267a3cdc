from pyspark.sql import functions as F

from shapelens.llm import langid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 < r.score <= 1 for r in rows)


def test_gradients():
    import numpy as np

    from shapelens.llm.gru import Gru

    random = np.random.default_rng(1)
    gru = Gru(5, 3, random)
    gru.p = {k: v.astype(np.float64) for k, v in gru.p.items()}
    x, real = random.integers(0, 5, (6, 4)), random.random((6, 4)) < 0.8
    weight, h = random.normal(size=(6, 4, 3)), random.normal(size=(4, 3))

    def loss():
        states = h
        out = []
        for t in range(6):
            new = gru.step(x[t], states)
            states = np.where(real[t][:, None], new, states)
            out.append(states)
        return float((np.stack(out) * weight).sum())

    _, kept = gru.forward(x, h, real)
    grads = gru.backward(x, real, kept, weight)
    for name, values in gru.p.items():
        for at in [tuple(random.integers(0, s) for s in values.shape) for _ in range(8)]:
            old = values[at]
            values[at] = old + 1e-5
            up = loss()
            values[at] = old - 1e-5
            slope = (up - loss()) / 2e-5
            values[at] = old
            assert abs(slope - grads[name][at]) < 1e-3 * max(1, abs(slope)), name


def test_runs_are_computed_alone(make):
    runs = [b"abc", "größe".encode(), b"x" * 62, b"a"]
    tagger = langid.train_tagger(runs * 5, ["de", "en", "fr", "en"] * 5, steps=3)
    together, lengths = tagger.labels(runs)
    for i, run in enumerate(runs):
        alone, n = tagger.labels([run])
        assert abs(alone[0] - together[i]).max() < 1e-4 and n[0] == lengths[i] == len(run)
        assert abs(alone.sum() - len(run)) < 1e-3
    assert b"".join(langid.runs_of("x" * 200)) == b"x" * 200


def test_sample_takes_languages_in_turn(make):
    rows = [(i, f"common {i}", "en") for i in range(400)] + [(400 + i, f"selten {i}", "de") for i in range(6)]
    rows += [(1000, f"again {i}", "fr") for i in range(50)] + [(1001, None, "fr"), (None, "x", "fr")]
    chosen = lambda most: langid._sample(make(rows), "doc_id", "text", "lang", (1, 5), most).collect()
    some = chosen(30)
    by = {x: sorted(r.text for r in some if r.lang == x) for x in ("en", "de", "fr")}
    assert by["de"] == [f"selten {i}" for i in range(6)] and by["fr"] == ["again 0"] and len(by["en"]) == 23
    assert sorted(r.text for r in chosen(30)) == sorted(r.text for r in some)
    assert len(chosen(10_000)) == 407


def test_odd_rows(odd, make):
    docs = odd.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise(F.lit(None)))
    rows = {r.doc_id: r for r in langid.language_report(docs).collect()}
    assert {k for k, r in rows.items() if r.lang_pred == "und"} == {1, 2, 3, 7}
    assert {r.lang_pred for k, r in rows.items() if k not in (1, 2, 3, 7)} == {"aa"}
    nothing = langid.language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"} and len(nothing) == odd.count()
    assert langid.language_report(docs.where("false")).count() == 0
