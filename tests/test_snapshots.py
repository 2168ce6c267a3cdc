"""Snapshots, the load ledger and hot schema hashes."""

import json
import pathlib
import threading

import pytest
from pyspark.sql import functions as F

from shapelens.operators import ledger
from shapelens.session import intermediates, sized
from shapelens.sources.registry import hot_schemas, read_structure_registry, schema_registry_lookup, write_structure_registry
from shapelens.sources.snapshots import SnapshotConflict, current, expire, last_number, snapshots, write_snapshot


def test_killed_overwrite_leaves_the_earlier_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    assert current(spark, path) is None and read_structure_registry(spark, path) is None
    write_structure_registry(spark.range(3), path, "9")
    # data without a manifest, and a manifest whose writer died
    spark.range(50).write.parquet(f"{path}/data/dead")
    (pathlib.Path(path) / "manifests" / "000000000002.json").write_text("")
    assert read_structure_registry(spark, path).count() == 3

    def fail(batches):
        raise RuntimeError("lost")
        yield

    with pytest.raises(Exception):
        write_snapshot(spark.range(5).mapInArrow(fail, "id long"), path, "10")
    assert current(spark, path).run == "9"
    write_structure_registry(spark.range(7), path, "10-q-2")
    assert read_structure_registry(spark, path).count() == 7 and read_structure_registry(spark, path, "9").count() == 3
    assert [s.number for s in snapshots(spark, path)] == [1, 3]


def test_two_writers_conflict(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(spark.range(1), path, "a")
    seen = last_number(spark, path)
    write_snapshot(spark.range(2), path, "b", seen)
    with pytest.raises(SnapshotConflict):
        write_snapshot(spark.range(3), path, "c", seen)
    assert current(spark, path).run == "b" and len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_expired_snapshots_are_gone(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        write_snapshot(spark.range(i + 1), path, str(i))
    expire(spark, path, 2)
    assert [s.run for s in snapshots(spark, path)] == ["2", "3"] and len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert write_snapshot(spark.range(1), path, "4").number == 5


def test_own_tables_of_a_thread_leave_others_alone(spark):
    """A stream's batch ends while another thread has just written a table."""
    inside, done, found = threading.Event(), threading.Event(), []

    def batch():
        with intermediates(spark):
            sized(spark.range(3))
            inside.set()
            done.wait(30)

    thread = threading.Thread(target=batch)
    thread.start()
    inside.wait(30)
    found.append(sized(spark.range(5)))
    done.set()
    thread.join()
    assert found[0].count() == 5


def land(spark, keys):
    return spark.createDataFrame([(k, json.dumps({"id": k, "v": i})) for i, k in enumerate(keys)], "rowkey string, json string")


@pytest.fixture(scope="module")
def structure(spark):
    rows = [("t", p, p or "", p != "") for p in ("", "id", "v")]
    return spark.createDataFrame([(t, p, n, leaf, "TEXT" if leaf else None) for t, p, n, leaf in rows], "event_type string, path string, name string, is_leaf boolean, primitive string")


def test_ledger_is_the_mark(spark, structure, tmp_path):
    path = str(tmp_path / "load")
    keys = [f"T-17040{d}0000-{i}" for d in range(3) for i in range(5)]
    early = [k for k in keys[:10] if not k.endswith("-3")]
    first = ledger.load(land(spark, early), structure, "t", path, 1)
    assert (first.low, first.high, first.n_rows) == ("T-0", "T-1704010000-4", 8)
    # nobody passes a mark; a late row stands below it
    second = ledger.load(land(spark, keys), structure, "t", path, 2)
    assert (second.low, second.n_rows) == (first.high, 5)
    assert ledger.load(land(spark, keys), structure, "t", path, 3) is None
    assert {r.rowkey for r in ledger.late_keys(land(spark, keys), path, "t").collect()} == {"T-1704000000-3", "T-1704010000-3"}
    # run 1 again, now with the late rows there: its own range only
    again = ledger.load(land(spark, keys), structure, "t", path, 1)
    assert (again.low, again.high, again.n_rows) == (first.low, first.high, 10)
    assert ledger.late_keys(land(spark, keys), path, "t").count() == 0 and ledger.load_late(land(spark, keys), structure, "t", path, 4) is None
    more = land(spark, [*keys, "T-1704000000-x", "T-nokey"])
    late = ledger.load_late(more, structure, "t", path, 4)
    assert late.n_rows == 1 and ledger.saved_mark(spark, path, "t") == second.high
    table = ledger.loaded(spark, path, "t")
    assert table.count() == table.select("rowkey").distinct().count() == 16
    with pytest.raises(ValueError):
        ledger.load_late(more, structure, "t", path, 4)


def test_two_loads_at_a_time_conflict(spark, structure, tmp_path, monkeypatch):
    path = str(tmp_path / "load")
    ledger.load(land(spark, ["T-1704000000-1"]), structure, "t", path, 1)
    monkeypatch.setattr(ledger, "last_number", lambda *_: 0)
    with pytest.raises(SnapshotConflict):
        ledger.load(land(spark, ["T-1704000000-1", "T-1704000000-2"]), structure, "t", path, 2)
    monkeypatch.undo()
    assert ledger.loaded(spark, path, "t").count() == 1


def test_no_large_task_for_a_hot_hash(spark):
    """A third of all rows has one hash, a third an unknown one, and nothing may be broadcast by size."""
    n = 30_000
    hash_ = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "unknown").otherwise(F.concat(F.lit("h"), (F.col("id") % 5000).cast("string")))
    messages = spark.range(n).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), hash_.alias("schema_hash")).repartition(6)
    registry = spark.range(5000).select(F.concat(F.lit("h"), "id").alias("schema_hash"), F.col("id").cast("string").alias("schema_json")).unionByName(
        spark.createDataFrame([("hot", "HOT"), ("other", "x")], "schema_hash string, schema_json string"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = schema_registry_lookup(messages, registry)
        tasks = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(tasks) < 1.5 * n / 8 and sum(tasks) == n
        wrong = found.where("""not (schema_json <=> case when schema_hash = 'hot' then 'HOT' when schema_hash = 'unknown' then null else substring(schema_hash, 2) end)""")
        assert wrong.count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    hot = hot_schemas(messages.select("schema_hash"), registry.withColumnRenamed("schema_hash", "_hash"))
    assert {tuple(r) for r in hot.collect()} == {("hot", "HOT"), ("unknown", None)}
    assert hot_schemas(messages.select("schema_hash"), registry.withColumnRenamed("schema_hash", "_hash"), chars=2).count() <= 1


def test_lookup_deals_texts_by_their_bytes(spark, monkeypatch):
    """A registry whose texts are long is not broadcast, however small Catalyst takes it for, and more text means more tasks."""
    from shapelens.sources import registry

    rows = spark.range(3000).selectExpr("md5(string(id)) as schema_hash", "concat(id, repeat('x', 1000)) as schema_json")
    messages = spark.range(3100).selectExpr("'t' as topic", "0 as partition", "id as offset", "if(id % 31 = 30, null, md5(string(id))) as schema_hash")
    want = {r.offset: r.schema_json for r in messages.join(rows, "schema_hash", "left").collect()}
    assert registry.text_bytes(rows) > 3_000_000 and registry.text_bytes(rows.where("false")) == 0
    monkeypatch.setattr(registry, "HOT_CHARS", 1_000_000)
    monkeypatch.setattr(registry, "TASK_BYTES", 200_000)
    tasks = registry.lookup_tasks(messages, registry.text_bytes(rows))
    assert tasks >= 16
    assert registry.lookup_tasks(messages.where("false").withColumn("n_bytes", F.lit(1)), 0) == 8
    found = registry.schema_registry_lookup(messages, rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and f", {tasks})" in plan
    assert {r.offset: r.schema_json for r in found.collect()} == want and found.count() == 3100
