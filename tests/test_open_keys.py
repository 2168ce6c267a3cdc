"""Objects whose keys are data."""

import json

import pytest
from pyspark.sql import functions as F

from shapelens.functions.json_types import types_in
from shapelens.operators import drift, views, warehouse
from shapelens.operators.open_keys import open_of
from shapelens.operators.paths import json_paths
from shapelens.operators.structure import from_registry, merge_structures


def frame(spark, documents, event_type="t"):
    rows = [(event_type, json.dumps(d)) for d in documents]
    return spark.createDataFrame(rows, "event_type string, json string").repartition(4).select(
        "event_type", F.try_parse_json("json").alias("event"), F.col("json").alias("event_text"))


def counts(paths):
    return {r.path: (set(r.types), r.n_trees) for r in paths.select("path", types_in("mask").alias("types"), "n_trees").collect()}


def test_a_million_keys_give_one_path(spark):
    """100,000 events with ten new keys each, all different."""
    ids = spark.range(100_000).selectExpr("'t' as event_type", """concat('{"id":', id, ',"m":{', array_join(transform(sequence(0, 9), k ->
        concat('"k', id * 10 + k, '":', if(k % 2 = 0, '1', '"x"'))), ','), '}}') as event_text""")
    rows = json_paths(ids.selectExpr("*", "parse_json(event_text) as event"))
    assert counts(rows) == {"": ({"OBJECT"}, 100_000), "id": ({"INTEGER"}, 100_000), "m": ({"OBJECT"}, 100_000), r"m.\*": ({"INTEGER", "TEXTUAL"}, 100_000)}


def test_fields_stay_and_nested_objects_open_in_turn(spark):
    docs = [{"id": i, f"x{i}": 1, "m": {"total": i, f"u{i}": {"v": {f"d{i % 40}-{i}": [1, {"q": i}]}, "n": None}}, "rare" if i % 50 == 0 else "often": 2} for i in range(400)]
    got = counts(json_paths(frame(spark, docs), open_from=30, field_share=0.5))
    assert set(got) == {"", "id", "often", "m", "m.total", r"m.\*", r"m.\*.v", r"m.\*.n", r"m.\*.v.\*", r"m.\*.v.\*.q", r"\*"}
    assert all(n == 400 for p, (_, n) in got.items() if p != "often") and got["often"][1] == 392
    assert got[r"\*"][0] == {"INTEGER"} and got[r"m.\*.v.\*"][0] == {"ARRAY"}


def test_keys_that_look_like_the_wild_segment(spark):
    docs = [{"*": 1, "\\*": 2, "a": {"*": {"\\*": 1}}} for _ in range(3)]
    got = counts(json_paths(frame(spark, docs), open_from=5))
    assert set(got) == {"", "*", r"\\*", "a", "a.*", r"a.*.\\*"}


def test_open_only_over_runs(spark):
    """Each run is below the limit, all together are not; later runs go on from there."""
    one, two, three = (frame(spark, [{"id": i, "m": {f"k{i}": 1.5}} for i in range(n, n + 30)]) for n in (0, 30, 60))
    first = merge_structures(json_paths(one, open_from=40), open_from=40, field_share=0.5)
    assert first.where("path like 'm.%'").count() == 30
    second = merge_structures(json_paths(two, open_from=40, known=open_of(first)), from_registry(first), open_from=40, field_share=0.5)
    found = {r.path: (r.n_trees, r.is_map, r.is_leaf, r.primitive) for r in second.collect()}
    assert found["m"] == (60, True, True, "TEXT") and found[r"m.\*"][:3] == (60, False, False) and len(found) == 4
    assert {r.path for r in json_paths(three, open_from=40, known=open_of(second)).collect()} == set(found)


@pytest.fixture(scope="module")
def structure(spark):
    docs = [{"id": i, "eventType": "t", "timestamp": 1704067200000 + i, "m": {f"k{i}": {"a": i}}, "tags": {f"t{i}": i / 2}} for i in range(60)]
    return merge_structures(json_paths(frame(spark, docs), open_from=20, field_share=0.5), open_from=20, field_share=0.5).cache()


def test_views_read_maps(spark, structure):
    landed = spark.createDataFrame([("T-1704067200-1", '{"id":1,"m":{"q":{"a":5},"r":{"a":6}},"tags":{"z":0.5}}')], "rowkey string, json string")
    view = views.flatten_typed(landed, structure, "t")
    assert dict(view.dtypes)["m"] == "map<string,struct<a:bigint>>" and dict(view.dtypes)["tags"] == "map<string,double>"
    row = view.first()
    assert row.m["q"].a == 5 and set(row.m) == {"q", "r"} and row.tags == {"z": 0.5}
    assert views.flatten_untyped(landed, structure, "t").columns == ["row_key", "row_timestamp", "eventType", "id", "m", "tags", "timestamp"]
    assert json.loads(views.json_tuple_view(landed, structure, "t").first().m) == {"q": {"a": 5}, "r": {"a": 6}}


def test_columns_of_maps(spark, structure):
    assert {r.column_path: r.column_type for r in drift.column_list(structure).collect()} == {
        "id": "bigint", "eventType": "string", "timestamp": "bigint", "m": "map<string,string>", "tags": "map<string,string>"}
    assert {(r.column_name, r.column_type) for r in warehouse.warehouse_columns(structure).collect()} >= {("m", "NVARCHAR(255)"), ("tags", "NVARCHAR(255)")}
    landed = spark.createDataFrame([("T-1704067200-1", '{"id":1,"m":{"q":{"a":5}}}')], "rowkey string, json string")
    assert json.loads(warehouse.load_warehouse_increment(landed, structure, "t").first().m) == {"q": {"a": 5}}
