"""Views, loads, Avro schemas, drift, the registry and the stream."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shapelens.operators import drift, views, warehouse
from shapelens.operators.avro import avro_paths, avro_structures
from shapelens.operators.decode import classify_events, decode_messages
from shapelens.operators.paths import json_paths
from shapelens.operators.structure import merge_structures
from shapelens.operators.views import ColumnClash
from shapelens.plans.analysis import analyse, learn_structures
from shapelens.sources.landed import rowkey_range, write_landed_events
from shapelens.sources.registry import read_structure_registry, write_structure_registry
from shapelens.session import shared_dir
from shapelens.streaming.structures import latest_structures, merge_batch, stream_structures

DOCUMENTS = [
    {"id": 1, "timestamp": 1704067207179, "eventType": "t", "p": {"a": 1, "odd-name": "x"}, "arr": [{"d": 1}, {"d": "x"}], "tags": ["u", "v"]},
    {"id": 2, "timestamp": 1704153607000, "eventType": "t", "p": {"a": 2.5}, "arr": [], "tags": None},
    {"id": 3, "timestamp": 1706659200000, "eventType": "t", "flag": True},
]


def messages(spark, documents):
    return spark.createDataFrame([("topic", 0, i, json.dumps(d).encode()) for i, d in enumerate(documents)],
                                 "topic string, partition int, offset bigint, value binary")


def land(spark, documents):
    return spark.createDataFrame(
        [(f"T-{d['timestamp'] // 1000}-{d['id']}", json.dumps(d)) for d in documents] + [("T-9", "{}"), ("U-1704067207-1", "{}")],
        "rowkey string, json string")


@pytest.fixture(scope="module")
def structure(spark):
    out = learn_structures(messages(spark, DOCUMENTS)).cache()
    yield out
    out.unpersist()


def test_typed_view(spark, structure):
    view = views.flatten_typed(land(spark, DOCUMENTS), structure, "t")
    assert view.columns == ["rowkey", "arr", "eventType", "flag", "id", "p_a", "p_oddname", "tags", "timestamp"]
    assert dict(view.dtypes)["arr"] == "array<struct<d:string>>" and dict(view.dtypes)["p_a"] == "double"
    got = {r.id: r for r in view.collect()}
    assert len(got) == 3 and got[1].p_oddname == "x" and got[1].tags == ["u", "v"] and [i.d for i in got[1].arr] == ["1", "x"]
    assert got[2].timestamp == datetime.fromtimestamp(1704153607)


def test_scopes_and_bounds(spark, structure):
    rows = land(spark, DOCUMENTS)
    assert views.flatten_typed(rows, structure, "t", "day", datetime(2024, 1, 31, 12)).count() == 1
    assert rowkey_range(rows, "t").count() == 3 and rowkey_range(rows, "t", inclusive=True).count() == 4
    counts = views.day_count(rows, ["t", "u", "none"], "all").collect()
    assert {r.event_type: r.day_count for r in counts} == {"t": 3, "u": 1, "none": 0}


def test_key_range_and_columns_reach_the_scan(spark, structure, tmp_path):
    path = str(tmp_path / "landed")
    write_landed_events(land(spark, DOCUMENTS), path)
    view = views.flatten_typed(spark.read.parquet(path), structure, "t", "week", datetime(2024, 1, 31)).select("p_a")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rowkey,T-1706054400)" in plan and "LessThan(rowkey,T-9)" in plan
    assert "arr" not in plan.split("from_json", 1)[-1].split(",", 1)[0]


def test_untyped_json_tuple_and_arrays(spark, structure):
    rows = land(spark, DOCUMENTS)
    untyped = views.flatten_untyped(rows, structure, "t").where("row_key <> 'T-9'")
    assert sorted(r[0] for r in untyped.select(F.col("p_a").cast("double")).collect() if r[0]) == [1.0, 2.5]
    flat = views.json_tuple_view(rows, structure, "t")
    assert {r.rowkey: r.p_a for r in flat.collect()}["T-1704153607-2"] == "2.5"
    items = views.explode_arrays(rows, structure, "t", "arr").orderBy("rowkey", "arr_array_index").collect()
    assert [(r.arr_array_index, r.arr_d) for r in items] == [(0, "1"), (1, "x"), (None, None), (None, None)]
    tags = views.explode_arrays(rows, structure, "t", "tags").where("tags_item is not null").collect()
    assert sorted(r.tags_item for r in tags) == ["u", "v"]


def test_views_are_created(spark, structure):
    names = views.create_views(spark, land(spark, DOCUMENTS), structure, "t", datetime(2024, 1, 31, 12))
    assert names == ["t", "t_last_day", "t_last_week"]
    assert [spark.table(n).count() for n in names] == [3, 1, 1]


def test_clashing_columns(spark):
    clash = learn_structures(messages(spark, [{"eventType": "t", "timestamp": 1, "a_b": 1, "a": {"b": 2}}]))
    with pytest.raises(views.ColumnClash):
        views.flatten_typed(land(spark, DOCUMENTS), clash, "t")
    assert "a_b_2" in views.flatten_typed(land(spark, DOCUMENTS), clash, "t", on_clash="suffix").columns
    with pytest.raises(views.ColumnClash):
        warehouse.check_clashes(clash)


def test_map_paths(spark):
    maps = learn_structures(messages(spark, [{"eventType": "t", "timestamp": 1, "m": {"k1": 1}}, {"eventType": "t", "timestamp": 1, "m": {"k2": "x"}}]))
    view = views.flatten_typed(land(spark, DOCUMENTS), maps, "t", map_paths=["m"])
    assert dict(view.dtypes)["m"] == "map<string,string>"


def test_warehouse(spark, structure, tmp_path):
    types = {r.column_name: r.column_type for r in warehouse.warehouse_columns(structure).collect()}
    assert types == {"arr_d": "NVARCHAR(255)", "eventType": "NVARCHAR(255)", "flag": "BIT", "id": "BIGINT", "p_a": "NUMERIC(18, 5)",
                     "p_odd-name": "NVARCHAR(255)", "tags": "NVARCHAR(255)", "timestamp": "BIGINT"}
    mapping = warehouse.load_mapping(structure).collect()
    assert [r.kv_index for r in mapping] == list(range(9)) and mapping[1].source_path == "$.arr.d"
    rows, path = land(spark, DOCUMENTS), str(tmp_path / "load")
    mark = warehouse.append_increment(rows.where("rowkey < 'T-1706'"), structure, "t", path, run_id=1)
    assert mark == "T-1704153607-2"
    mark = warehouse.append_increment(rows.where("rowkey <> 'T-9'"), structure, "t", path, mark, run_id=2)
    assert mark == "T-1706659200-3" and spark.read.parquet(path).count() == 3
    assert warehouse.append_increment(rows.where("rowkey <> 'T-9'"), structure, "t", path, mark, run_id=3) == mark


def test_pivot(spark):
    data = [("j", "A", "1"), ("j", "B", "2"), ("k", "B", "3"), ("k", "C", "4")]
    got = warehouse.pivot_parameters(spark.createDataFrame(data, "param_filter string, parameter_key string, parameter_value string"), {"A": "a", "B": "b"})
    assert sorted((r.param_filter, r.a, r.b) for r in got.collect()) == [("j", "1", "2"), ("k", None, "3")]


SCHEMA = {
    "type": "record", "name": "E", "namespace": "n.s", "fields": [
        {"name": "maybe", "type": ["null", "string"]}, {"name": "kind", "type": {"type": "enum", "name": "K", "symbols": ["X", "Y"]}},
        {"name": "kinds", "type": {"type": "array", "items": "K"}}, {"name": "attrs", "type": {"type": "map", "values": ["null", "int"]}},
        {"name": "either", "type": [{"type": "record", "name": "A", "fields": [{"name": "x", "type": "int"}]},
                                    {"type": "record", "name": "B", "fields": [{"name": "x", "type": "string"}, {"name": "y", "type": "n.s.A"}]}]},
        {"name": "hash", "type": {"type": "fixed", "name": "F", "size": 4}},
        {"name": "deep", "type": {"type": "array", "items": {"type": "array", "items": ["null", "A"]}}}]}


def test_avro_schema(spark):
    registry = spark.createDataFrame([("h", json.dumps(SCHEMA))], "schema_hash string, schema_json string")
    paths = avro_paths(registry)
    got = {r.path: r for r in paths.collect()}
    assert set(got) == {"", "maybe", "kind", "kinds", "attrs", "either", "either.x", "either.y", "either.y.x", "hash", "deep", "deep.x"}
    assert got["maybe"].optional and got["maybe"].avro_union_types == ["NULL", "STRING"] and not got["either"].optional
    assert got["kind"].avro_enum_symbols == ["X", "Y"] == got["kinds"].avro_enum_symbols and got["kinds"].avro_item_types == ["ENUM"]
    assert got["kinds"].avro_item_names == ["K"] and got["attrs"].avro_map_value_types == ["INT", "NULL", "UNION"]
    assert got["either.x"].avro_types == ["INT", "STRING"] and got["either"].avro_union_types == ["RECORD"]
    used = spark.createDataFrame([("e", "h")], "event_type string, schema_hash string")
    merged = {r.path: r for r in merge_structures(avro_structures(paths, used)).collect()}
    assert merged["maybe"].primitive == "TEXT" and merged["either.x"].primitive == "TEXT" and merged["hash"].primitive == "TEXT"
    assert merged["kinds"].is_array and merged["kinds"].item_primitive == "TEXT"


def test_drift(spark, structure):
    now = drift.column_list(structure)
    before = now.where("column_path <> 'flag'").withColumn("column_type", F.when(F.col("column_path") == "p\\.a", "x").otherwise(F.col("column_type")))
    row = drift.view_drift(now, before).first()
    assert row.status == "changed" and row.added == ["flag"]
    assert drift.view_drift(now, now).first().status == "unchanged"
    assert drift.view_drift(now, now.where("false")).first().status == "new"


def test_whole_run(spark):
    reports = analyse(messages(spark, DOCUMENTS), land(spark, DOCUMENTS), as_of=datetime(2024, 1, 31, 12))
    assert reports["topics"].first().is_consistent and reports["event_types"].first().n_events == 3
    assert [r.day_count for r in reports["day_counts"].collect()] == [1]
    assert {(r.kind, r.subject) for r in reports["changes"].collect()} == {("change", "event type t")}


def result(table):
    return sorted((r.event_type, r.path, r.optional, r.n_trees, tuple(r.json_types)) for r in table.collect())


def test_stream_equals_batch(spark, tmp_path):
    documents = DOCUMENTS + [{"id": 4, "timestamp": 1, "eventType": "t", "p": {"b": None}}]
    source, path = str(tmp_path / "in"), str(tmp_path / "registry")
    for d in documents:
        messages(spark, [d]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(messages(spark, documents).schema).option("maxFilesPerTrigger", 2).parquet(source)
    stream_structures(stream, path, str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()
    batch = result(merge_structures(json_paths(classify_events(decode_messages(messages(spark, documents))))))
    assert result(latest_structures(spark, path)) == batch
    # a batch again: same snapshot, nothing counted twice
    merge_batch(messages(spark, documents[:1]), 5, path, "q")
    once = result(latest_structures(spark, path))
    merge_batch(messages(spark, documents[:1]), 5, path, "q")
    assert result(latest_structures(spark, path)) == once != batch


def test_stream_with_a_new_checkpoint_goes_on(spark, tmp_path):
    path, batches = str(tmp_path / "registry"), [[d] for d in DOCUMENTS]
    for i, documents in enumerate(batches):
        merge_batch(messages(spark, documents), i % 2, path, f"query{i // 2}", keep=2)
    batch = result(merge_structures(json_paths(classify_events(decode_messages(messages(spark, DOCUMENTS))))))
    assert result(latest_structures(spark, path)) == batch
    assert len(list((tmp_path / "registry" / "data").iterdir())) == 2
    assert not list(__import__("pathlib").Path(shared_dir(spark).removeprefix("file:")).glob("sized-*/_temporary"))


ODD = {"it's": 1, 'say "it\'s"': {"x": 2}, "x": "low", "X": "high", "a": [{"b": [{"c": "1"}, {"c": 2}], "q": "s"}, {"b": []}], "a_b": 1, "a-b": 2}


def test_odd_keys_in_views(spark):
    documents = [{"id": 1, "timestamp": 1704067200000, "eventType": "t", **ODD}]
    structure = merge_structures(json_paths(classify_events(decode_messages(messages(spark, documents)))))
    landed = land(spark, documents)
    for build in (views.flatten_typed, views.flatten_untyped, views.json_tuple_view):
        with pytest.raises(ColumnClash):
            build(landed, structure, "t").count()
    typed = views.flatten_typed(landed, structure, "t", on_clash="suffix").first().asDict()
    assert (typed["its"], typed["say its_x"], {v for k, v in typed.items() if k.lower() in ("x", "x_2")}) == (1, 2, {"low", "high"})
    loose = views.flatten_untyped(landed, structure, "t", on_clash="suffix")
    assert loose.select(F.col("`say its_x`").cast("int"), F.col("its").cast("int")).first() == (2, 1)
    assert len(set(map(str.lower, views.json_tuple_view(landed, structure, "t", on_clash="suffix").columns))) == len(views.json_tuple_view(landed, structure, "t", on_clash="suffix").columns)
    nested = views.explode_arrays(landed, structure, "t", "a.b")
    assert [tuple(r)[1:] for r in nested.orderBy("a_array_index", "a_b_array_index").collect()] == [(0, 0, "1"), (0, 1, "2"), (1, None, None)]
    assert [tuple(r)[1:3] for r in views.explode_arrays(landed, structure, "t", "a").select("rowkey", "a_array_index", "a_q").orderBy("a_array_index").collect()] == [(0, "s"), (1, None)]
    with pytest.raises(LookupError):
        views.explode_arrays(landed, structure, "t", "id")


def test_recursive_schema_beside_a_good_one(spark):
    node = {"type": "record", "name": "Node", "fields": [{"name": "v", "type": "int"}, {"name": "next", "type": ["null", "Node"]}, {"name": "all", "type": {"type": "array", "items": "Node"}}]}
    registry = spark.createDataFrame([("r", json.dumps(node)), ("g", json.dumps({"type": "record", "name": "G", "fields": [{"name": "x", "type": "long"}]}))], "schema_hash string, schema_json string")
    rows = {(r.schema_hash, r.path): r for r in avro_paths(registry).collect()}
    assert set(rows) == {("r", ""), ("r", "v"), ("r", "next"), ("r", "all"), ("g", ""), ("g", "x")}
    assert rows["r", "next"].recursive and rows["r", "next"].avro_union_types == ["NULL", "RECORD"] and not rows["r", "v"].recursive


def test_one_bad_type_leaves_the_others(spark):
    documents = [{"id": i, "timestamp": 1704067200000, "eventType": t, **extra} for i, (t, extra) in enumerate(
        [("good", {"v": 1}), ("bad", {"a_b": 1, "a": {"b": 2}}), (12, {}), ("", {}), ("a-b", {}), ("a_b", {})])]
    reports = analyse(messages(spark, documents), land(spark, documents), as_of=datetime(2024, 1, 1, 1))
    assert {r.event_type: r.day_count for r in reports["day_counts"].collect()}.keys() == {"good", "12", "", "a-b", "a_b"}
    assert ("warning", "event type bad", "no view: ColumnClash") in {tuple(r) for r in reports["changes"].collect()}
    names = views.view_names(["a-b", "a_b", "good"])
    assert len(set(names.values())) == 3 and names["good"] == "good"
    again = analyse(messages(spark, documents), land(spark, documents), previous=reports["structures"], as_of=datetime(2024, 1, 1, 1))
    assert {r.status for r in again["drift"].collect()} <= {"unchanged"}


def test_run_reads_its_source_once(spark, tmp_path):
    messages(spark, DOCUMENTS).write.parquet(str(tmp_path / "in"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(str(tmp_path / "in"))
    analyse(source.mapInArrow(count, source.schema), land(spark, DOCUMENTS), as_of=datetime(2024, 1, 31, 12))["changes"].collect()
    assert seen.value == len(DOCUMENTS)


def test_registry_round_trip(spark, structure, tmp_path):
    path = str(tmp_path / "registry")
    assert read_structure_registry(spark, path) is None
    write_structure_registry(structure, path, "2024-01-01")
    assert result(read_structure_registry(spark, path)) == result(structure)
