"""Hand-made messages, one per decoding rule."""

import pytest
from pyspark.sql import functions as F

from shapelens.functions import messages as m
from shapelens.functions.naming import last_name, parent_path, path_depth, rowkey_timestamp, sanitize, split_path
from shapelens.operators.decode import (
    AvroUnavailable, classify_events, decode_avro, decode_messages, distinct_events, distinct_positions, split_broken, used_schemas)
from shapelens.operators.reports import broken_messages, event_type_report, example_event, topic_report
from shapelens.plans.analysis import classify, learn_structures
from shapelens.sources.registry import registry_from_base64, schema_conflicts, write_samples
from shapelens.sources.topics import sample_topics, select_topics, topic_partition_count

LAYOUT = "topic string, partition int, offset bigint, value binary"

# value, broken reason, invalid reason, event type
CASES = [
    (None, "null message", None, None),
    (b"", "unparsable message", None, None),
    (b"not json", "unparsable message", None, None),
    (b"x" * 40, "unknown schema", None, None),
    (b'[{"eventType":"a","timestamp":1704067207179}]', "unknown schema", None, None),
    (b"[1]", None, "no eventType", None),
    (b"7", None, "no eventType", None),
    (b'{"eventType":null,"timestamp":1}', None, None, "null"),
    (b'{"timestamp":1704067207179}', None, "no eventType", None),
    (b"{}", None, "no eventType", None),
    (b'{"eventType":"a"}', None, "no timestamp", None),
    (b'{"eventType":{"x":1},"timestamp":1}', None, None, ""),
    (b'{"eventType":12.50,"timestamp":1}', None, None, "12.5"),
    (b'{"eventType":true,"timestamp":null}', None, None, "true"),
    (b'\n\t {"eventType":"a","timestamp":1704067207179}', None, None, "a"),
    (b'{"eventType":"a","eventType":"b","timestamp":1}', None, None, "b"),
    (b'{"eventType":"a","timestamp":1} trailing text', None, None, "a"),
    (b'{"eventType":"a","timestamp":NaN}', "unparsable message", None, None),
    (b"\xff\xfe" * 20, "unknown schema", None, None),
    (b'{"eventType":"a\xff","timestamp":1}', None, None, "a�"),
    (b'{"eventType":"\xc3\xa4","timestamp":1704067207179,"version":2}', None, None, "ä"),
]


def rows(spark, values, topic="t"):
    return spark.createDataFrame([(topic, 0, i, v) for i, v in enumerate(values)], LAYOUT)


def test_classification(spark):
    got = classify_events(decode_messages(rows(spark, [c[0] for c in CASES]))).orderBy("offset").collect()
    assert [(r.broken_reason, r.invalid_reason, r.event_type) for r in got] == [c[1:] for c in CASES]
    assert [r.timestamp_unit for r in got][-1] == "MILLISECONDS" and got[-1].version == "2"
    assert got[13].timestamp_text == "null"


def test_every_message_lands_once(spark):
    classified = classify_events(decode_messages(rows(spark, [c[0] for c in CASES])))
    readable, broken = split_broken(classified)
    assert readable.count() + broken.count() == len(CASES)
    assert broken_messages(classified).where("text is null").count() == 1


def test_parse_is_planned_once(spark):
    plan = event_type_report(classify_events(decode_messages(rows(spark, [b"{}"]))))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1


def test_timestamp_units(spark):
    values = [b'{"eventType":"a","timestamp":17040672071}', b'{"eventType":"a","timestamp":"170406720717"}']
    got = classify_events(decode_messages(rows(spark, values))).select(
        "timestamp_unit", m.event_timestamp(F.col("timestamp_text")).cast("string").alias("t")).orderBy("offset").collect()
    assert [r.timestamp_unit for r in got] == ["SECONDS", "MILLISECONDS"]
    assert got[1].t.startswith("1975-05-27")


def test_distinct_keeps_one_copy_per_group(spark):
    same = b'{"eventType":"a","timestamp":1704067207179}'
    both = rows(spark, [same, same, b'{"eventType":"b","timestamp":1}'], "x").unionByName(rows(spark, [same, None, None], "y"))
    assert [(r.topic, r.offset) for r in distinct_events(both).orderBy("topic", "offset").collect()] == [
        ("x", 0), ("x", 2), ("y", 0), ("y", 1), ("y", 2)]  # null messages have no bytes to compare
    typed = classify_events(decode_messages(both)).where("event_type is not null")
    assert {r.event_type: r["count"] for r in distinct_events(typed, ["event_type"]).groupBy("event_type").count().collect()} == {"a": 1, "b": 1}
    report = {r.event_type: r for r in event_type_report(typed).collect()}
    assert report["a"].n_events == 1 and report["a"].topics == ["x", "y"] and report["a"].is_consistent
    assert not report["b"].is_consistent and "a single event says nothing about consistency" in report["b"].messages
    topics = {r.topic: r for r in topic_report(classify_events(decode_messages(both))).collect()}
    assert (topics["y"].n_events, topics["y"].n_broken, topics["y"].n_null) == (1, 2, 2)
    assert example_event(typed).orderBy("event_type").first().offset == 0


def test_sampling(spark):
    data = [("t", p, o, b"x") for p, n in ((0, 3), (1, 4), (2, 9)) for o in range(n)]
    messages = spark.createDataFrame(data, LAYOUT)
    got = sample_topics(messages, 5).orderBy("partition", "offset").collect()
    assert [(r.partition, r.offset) for r in got] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]
    # in turn: 3 of partition 0, then 4 of partition 1 (overshooting 5), none of partition 2
    got = sample_topics(messages, 5, per_partition=True).groupBy("partition").count().collect()
    assert {r.partition: r["count"] for r in got} == {0: 3, 1: 4}
    assert topic_partition_count(messages).first().n_partitions == 3


def test_topic_choice(spark):
    names = spark.createDataFrame([("a",), ("b",), ("_x",), ("avro_schema",)], "topic string")
    assert {r.topic for r in select_topics(names).collect()} == {"a", "b"}
    assert {r.topic for r in select_topics(names, ["b", "_x"]).collect()} == {"b"}


def test_registry(spark):
    table = spark.createDataFrame([("avro-schemas/h1", "eyJ0eXBlIjoibG9uZyJ9"), ("avro-schemas/h2", "e30=")], "key string, value string")
    registry = registry_from_base64(table)
    assert registry.where("schema_hash = 'h1'").first().schema_json == '{"type":"long"}'
    twice = registry.unionByName(registry).unionByName(spark.createDataFrame([("h2", "[]")], registry.schema))
    assert [tuple(r) for r in schema_conflicts(twice).collect()] == [("h2", 2)]


def test_avro_lookup_and_guard(spark):
    known, unknown = "k" * 32, "u" * 32
    registry = spark.createDataFrame([(known, '{"type":"long"}')], "schema_hash string, schema_json string")
    decoded = decode_messages(rows(spark, [known.encode() + b"\x02", unknown.encode() + b"\x02", b'{"a":1}']), registry)
    assert [r.broken_reason for r in decoded.orderBy("offset").collect()] == [None, "unknown schema", None]
    with pytest.raises(AvroUnavailable):
        decode_avro(decoded, {known: '{"type":"long"}'})


def test_samples_skip_full_types(spark, tmp_path):
    values = [b'{"eventType":"%s","timestamp":%d}' % (t, i) for i in range(4) for t in (b"a", b"b")][:-3]
    events = classify_events(decode_messages(rows(spark, values)))
    path = str(tmp_path / "samples")
    write_samples(events, path, 3)
    write_samples(events.where("event_type = 'b'"), path, 3)
    counts = {r.event_type: r["count"] for r in spark.read.text(path).groupBy("event_type").count().collect()}
    assert counts == {"a": 3, "b": 2}


def test_names(spark):
    paths = ["", "a", "a.b", "a\\.b", "a\\.b.c", "\\0", "x.\\0"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(
        parent_path(F.col("p")), last_name(F.col("p")), path_depth(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [(None, "", 0), ("", "a", 1), ("a", "b", 2), ("", "a.b", 1), ("a\\.b", "c", 2), ("", "", 1), ("x", "", 2)]
    assert [split_path(p) for p in paths[1:]] == [["a"], ["a", "b"], ["a.b"], ["a.b", "c"], [""], ["x", ""]]
    assert sanitize("a-b.c$ dé") == "ab.c$ d"
    key = spark.createDataFrame([("T-1704067207-1",), ("nokey",)], "k string").select(rowkey_timestamp(F.col("k")).cast("string")).collect()
    assert [r[0] for r in key] == ["2024-01-01 00:00:07", None]


def test_undecoded_avro_is_neither_broken_nor_invalid(spark):
    known, unknown = "k" * 32, "u" * 32
    registry = spark.createDataFrame([(known, '{"type":"record","name":"R","fields":[{"name":"x","type":"long"}]}'), ("n" * 32, '"long"')], "schema_hash string, schema_json string")
    body = b'{"eventType":"a","timestamp":1704067207179,"x":1}'
    mixed = rows(spark, [known.encode() + body, unknown.encode() + body, body, known.encode() + b"#"])
    got = classify_events(decode_messages(mixed, registry)).orderBy("offset").collect()
    assert [(r.broken_reason, r.invalid_reason, r.undecoded, r.event_type) for r in got] == [
        (None, None, True, None), ("unknown schema", None, False, None), (None, None, False, "a"), (None, None, True, None)]
    assert used_schemas(decode_messages(mixed, registry)).keys() == {known}
    read = classify(mixed, registry, lambda value, _: value.cast("string"))
    assert [(r.broken_reason, r.event_type) for r in read.orderBy("offset").collect()] == [
        (None, "a"), ("unknown schema", None), (None, "a"), ("unparsable message", None)]
    assert read.where("is_avro and invalid_reason is not null").count() == 0
    report = event_type_report(read).first()
    assert report.avro_flags == [False, True] and report.schema_hashes == [known]
    learned = {r.path: r.n_trees for r in learn_structures(mixed, registry, decoder=lambda value, _: value.cast("string")).collect()}
    assert learned["x"] == 3 and learned["eventType"] == 2  # two events, and the schema that one of them carries
    told = learn_structures(mixed, registry, used=spark.createDataFrame([("a", known)], "event_type string, schema_hash string"))
    assert {r.path: r.n_trees for r in told.collect()}["x"] == 2  # undecoded: the JSON event and the schema


def test_samples_of_any_size(spark):
    messages = spark.createDataFrame([("t", i % 3, i + 2**47, b"x") for i in range(3000)] + [("u", 0, 1, b"x")], LAYOUT)
    got = sample_topics(messages, 1001)
    assert got.count() == 1002 and got.where("topic = 't'").agg(F.max("partition")).first()[0] == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "offset" in plan  # ranked tuples come from their table, rows by a range of positions


def test_positions_of_large_offsets(spark):
    same = b'{"eventType":"a","timestamp":1704067207179}'
    messages = spark.createDataFrame([("t", 0, 2**47 + 5, same), ("t", 1, 5, same), ("t", 1, 4, b"x"), ("t", 1, 3, None), ("t", 1, 2, None)], LAYOUT)
    assert sorted((r.partition, r.offset) for r in distinct_positions(messages).collect()) == [(0, 2**47 + 5), (1, 2), (1, 3), (1, 4)]
    assert (0, 2**47 + 5) in {(r.partition, r.offset) for r in distinct_events(messages).collect()}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = distinct_positions(messages)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # only messages in shared cells move; the table of cells, of a fixed size, is broadcast
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Join") == plan.count("BroadcastHashJoin") and "SortMergeJoin" not in plan
