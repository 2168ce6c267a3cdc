"""Reports per schema and structure, lineage over runs, offset indexes, copies, and the stateful stream."""

import json

import pytest
from pyspark.sql import functions as F

from shapelens.operators import lineage
from shapelens.operators.avro import avro_paths, tree_paths
from shapelens.operators.copies import in_shared_cell
from shapelens.operators.decode import classify_events, decode_messages, distinct_positions
from shapelens.operators.paths import json_paths
from shapelens.operators.structure import merge_structures
from shapelens.plans.analysis import analyse
from shapelens.sources import offsets, topics
from shapelens.sources.registry import read_structure_registry
from shapelens.sources.snapshots import current, snapshots
from shapelens.streaming.structures import latest_structures, stream_shapes


def messages(spark, documents, start=0):
    return spark.createDataFrame([("topic", 0, start + i, json.dumps(d).encode()) for i, d in enumerate(documents)], "topic string, partition int, offset bigint, value binary")


def result(table):
    return sorted((r.event_type, r.path, r.optional, r.n_trees, tuple(r.json_types)) for r in table.collect())


def test_lineage_over_changed_and_unchanged_runs(spark):
    edges = [(1, "t", "e1", "EVENT", "m1"), (1, "t", "a1", "AVRO", "m1"), (2, "t", "e2", "EVENT", "m2"), (2, "t", "m1", "DESERIALIZED", "m2"),
             (3, "t", "e2", "EVENT", "m2"), (3, "t", "m2", "DESERIALIZED", "m2"), (4, "t", "e4", "EVENT", "m4"), (4, "t", "m2", "DESERIALIZED", "m4"),
             (4, "u", "e2", "EVENT", "n1")]
    got = {tuple(r) for r in lineage.lineage(spark.createDataFrame(edges, lineage.EDGES)).collect()}
    want = {"m1": {("e1", 1), ("a1", 1)}, "m2": {("e1", 1), ("a1", 1), ("e2", 2)}, "m4": {("e1", 1), ("a1", 1), ("e2", 2), ("e4", 4)}}
    assert {(m, s, r) for t, m, s, _, r in got if t == "t"} == {(m, s, r) for m, found in want.items() for s, r in found}
    assert {x for x in got if x[0] == "u"} == {("u", "n1", "e2", "EVENT", 4)}


def test_lineage_of_many_runs(spark):
    """More steps than the default recursion limit."""
    edges = [(0, "t", "e0", "EVENT", "m0")] + [e for i in range(1, 130) for e in ((i, "t", f"e{i}", "EVENT", f"m{i}"), (i, "t", f"m{i - 1}", "DESERIALIZED", f"m{i}"))]
    found = lineage.lineage(spark.createDataFrame(edges, lineage.EDGES)).where("merged_id = 'm129'")
    assert found.count() == 130


def test_runs_hang_together_through_the_store(spark, tmp_path):
    store, landed = str(tmp_path / "store"), spark.createDataFrame([("T-1704067207-1", "{}")], "rowkey string, json string")
    one = [{"id": 1, "timestamp": 1704067207179, "eventType": "t", "a": 1}]
    two = [{"id": 2, "timestamp": 1704067207179, "eventType": "t", "b": "x"}]
    analyse(messages(spark, one), landed, store=store, run=1)["changes"].collect()
    second = analyse(messages(spark, two), landed, store=store, run=2)
    assert {(r.event_type, r.status) for r in second["drift"].collect()} == {("t", "changed")}
    assert {r.path for r in read_structure_registry(spark, f"{store}/structures").collect()} >= {"a", "b"}
    edges = current(spark, f"{store}/edges").read(spark)
    last = second["structure_sources"].where("source = 'MERGE'").first().structure_id
    assert lineage.lineage(edges).where(F.col("merged_id") == last).count() == 2
    assert {json.loads(r.value)["id"] for r in spark.read.text(f"{store}/samples").collect()} == {2}  # fewer than enough before: replaced
    # a run again: its edges are replaced
    analyse(messages(spark, two), landed, store=store, run=2)["changes"].collect()
    assert current(spark, f"{store}/edges").read(spark).groupBy("run", "source").count().where("count > 1").count() == 0


def test_nameless_trees_are_the_trees(spark):
    """Schemas that differ in their own name only, that use it, or take a namespace from it."""
    def record(name, fields, **extra):
        return json.dumps({"type": "record", "name": name, "fields": fields, **extra})

    inner = {"type": "record", "name": "In", "fields": [{"name": "x", "type": "int"}]}
    texts = [record(f"A{i}", [{"name": "f", "type": inner}, {"name": "g", "type": ["null", "In"]}]) for i in range(5)]
    texts += [record("Self", [{"name": "next", "type": ["null", "Self"]}]), record("n.s.Q", [{"name": "f", "type": inner}, {"name": "g", "type": "n.s.In"}]),
              record("f", [{"name": "f", "type": "int"}]), record("", []), record("type", [{"name": "v", "type": "long"}]), '"string"', "[]", "{}", "no json", '{"type":"array","items":"int"}']
    registry = spark.createDataFrame([(f"h{i}", t) for i, t in enumerate(texts)] + [("h0", texts[0]), ("h0", texts[5])], "schema_hash string, schema_json string")
    columns = ["schema_hash", "path", "optional", "avro_types", "avro_union_types", "avro_enum_symbols", "avro_item_types", "avro_item_names", "avro_map_value_types", "recursive"]
    got, want = ({repr(tuple(r)) for r in f(registry).select(*columns).collect()} for f in (avro_paths, tree_paths))
    assert got == want and len(got) > 20


def test_copies_are_all_that_moves(spark):
    rows = spark.range(20_000).selectExpr("'t' as topic", "cast(id % 4 as int) as partition", "id as offset",
                                          "cast(if(id % 100 = 7, concat('copy', id % 300), if(id % 500 = 9, null, concat('m', id))) as binary) as value").repartition(6)
    marked = in_shared_cell(rows, ["topic"])
    suspects = marked.where("_shared").count()
    assert 200 <= suspects < 300  # 200 copies, and the few that share a cell by chance
    got = distinct_positions(rows)
    assert got.count() == 20_000 - 200 + 3
    sizes = {r.n_copies for r in got.collect()}
    assert sizes == {1, 66, 67}
    few = {tuple(r) for r in in_shared_cell(rows, ["topic"], bits=6).where("_shared").select("offset").collect()}
    assert len(few) == rows.where("value is not null").count()


def test_empty_messages(spark):
    none = messages(spark, [{}]).where("false")
    assert distinct_positions(none).count() == 0 and in_shared_cell(none, ["topic"]).count() == 0


def test_offset_index_reads_the_sample_only(spark, tmp_path):
    path = str(tmp_path / "messages")
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'small', 'large') as topic", "cast(id % 5 as int) as partition", "id as offset", "cast(concat('m', id) as binary) as value")
    rows = rows.where("topic = 'large' or offset < 300")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        offsets.write_messages(rows, path, spark.range(9).selectExpr("'large' as topic", "cast(id as int) as partition"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = offsets.offsets(spark, path)
    assert {tuple(r) for r in offsets.partition_counts(index).collect()} == {("large", 9, 4, 20_000), ("small", 5, 0, 100)}
    for n, per_partition in ((10, False), (4500, False), (10, True), (5000, True), (50_000, True)):
        want = {tuple(r) for r in topics.sample_topics(rows, n, per_partition).select("topic", "partition", "offset").collect()}
        got = offsets.sample_messages(spark, path, n, per_partition)
        assert {tuple(r) for r in got.select("topic", "partition", "offset").collect()} == want
    chosen, files = offsets.files_of_sample(index, 10).select("file").distinct().count(), index.where("n > 0").select("file").distinct().count()
    assert chosen <= 2 < files
    unsorted = spark.createDataFrame([("t", 0, 1, 50, 50, "a"), ("t", 0, 10, 12, 3, "b"), ("t", 0, 60, 70, 5, "c"), ("t", 1, 1, 1, 1, "d")], "topic string, partition int, first long, last long, n long, file string")
    assert {r.file for r in offsets.files_of_sample(unsorted, 20).collect()} == {"a", "b"}


def test_stream_state_over_a_restart(spark, tmp_path):
    documents = [{"id": i, "timestamp": 1, "eventType": "t", "p": {"a": i} if i % 2 else None, "arr": [{"x": 1}] * (i % 3)} for i in range(6)]
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "registry"), str(tmp_path / "checkpoint")
    for half in range(2):
        for i, d in enumerate(documents[half * 3: half * 3 + 3]):
            messages(spark, [d], half * 3 + i).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(messages(spark, documents).schema).option("maxFilesPerTrigger", 2).parquet(source)
        stream_shapes(stream, path, checkpoint, availableNow=True).awaitTermination()
    assert result(latest_structures(spark, path)) == result(merge_structures(json_paths(classify_events(decode_messages(messages(spark, documents))))))
    assert len(snapshots(spark, path)) == 3


def test_files_of_a_stream_grow_with_its_rows(spark, monkeypatch):
    """No task writes or reads a fixed share of all rows, and batches stay as many."""
    from shapelens.plans import queries

    monkeypatch.setattr(queries, "STREAM_FILE_ROWS", 10)
    assert [queries._files(spark.range(n), 24) for n in (0, 240, 241, 2400)] == [24, 24, 48, 240]
