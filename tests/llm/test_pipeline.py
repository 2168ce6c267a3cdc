import corpus_pipeline
from shapelens.llm import decontam, secret_scan, toxicity


def test_stages_take_effect(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    out = corpus_pipeline.run(spark, sf_dir)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.columns[: len(docs.columns)] == docs.columns and 0 < len(rows) < docs.count()
    assert out.count() == len(rows)  # one row per document, with its number of copies
    items = decontam.searches([(str(r.item_id), r.text) for r in benchmark.collect()], 10)
    toxic = {r.doc_id for r in toxicity.toxicity_report(docs, labels).where("predicted = 1").collect()}
    for r in rows.values():
        assert r.doc_id not in toxic
        assert not decontam.hits_of(decontam.words_of(r.text), items)[0]
        assert not secret_scan.base_spans(r.text)
        assert r.copies in (1, 2)


def test_columns_between_stages(spark, odd, sf_dir):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == odd.columns, name
    assert docs.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0
