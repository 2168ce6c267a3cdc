"""Catalog views that are created only when they change, zone maps, and offset indexes."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shapelens.operators import catalog, views
from shapelens.operators.paths import json_paths
from shapelens.operators.structure import merge_structures
from shapelens.sources.landed import _touched, boundary_files, key_ranges, range_counts, read_landed_events, write_landed_events, zones


def learn(spark, documents):
    rows = [(d["eventType"], json.dumps(d)) for d in documents]
    frame = spark.createDataFrame(rows, "event_type string, event_text string").selectExpr("*", "parse_json(event_text) as event")
    return merge_structures(json_paths(frame))


DOCS = [{"id": 1, "timestamp": 1704067207179, "eventType": "t", "p": {"a": 1, "it's": "x"}}, {"id": 2, "timestamp": 1704153607, "eventType": "u", "X": 1, "x": "low"}]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landed") / "t")
    rows = [(f"{d['eventType'].upper()}-{str(d['timestamp'])[:10]}-{d['id']}", json.dumps(d)) for d in DOCS]
    write_landed_events(spark.createDataFrame(rows, "rowkey string, json string"), path)
    return path


def statuses(result):
    return {r.view_name: r.status for r in result.collect()}


def test_second_run_creates_none(spark, landed, tmp_path, monkeypatch):
    source, registry = f"parquet.`{landed}`", str(tmp_path / "views")
    structure = learn(spark, DOCS)
    first, failed = catalog.sync_views(spark, source, structure, registry, "cat1", on_clash="suffix")
    assert not failed and set(statuses(first).values()) == {"created"} and len(statuses(first)) == 6
    ran = []
    sql = spark.sql
    monkeypatch.setattr(spark, "sql", lambda text, *a, **b: (ran.append(text), sql(text, *a, **b))[1])
    second, _ = catalog.sync_views(spark, source, structure, registry, "cat1", on_clash="suffix")
    assert set(statuses(second).values()) == {"unchanged"} and not [t for t in ran if "CREATE OR REPLACE" in t]
    # a new field of one type: only that type's views run again
    third, _ = catalog.sync_views(spark, source, learn(spark, [{**DOCS[0], "new": 1.5}, DOCS[1]]), registry, "cat1", on_clash="suffix")
    assert {n for n, s in statuses(third).items() if s == "changed"} == {"t", "t_last_day", "t_last_week"}
    assert len([t for t in ran if "CREATE OR REPLACE" in t]) == 3 and "new" in spark.table("cat1.t").columns
    # a view that somebody dropped comes back; types that a run does not see stay
    sql("DROP VIEW cat1.u")
    fourth, _ = catalog.sync_views(spark, source, learn(spark, DOCS[1:]), registry, "cat1", on_clash="suffix")
    assert {n: s for n, s in statuses(fourth).items()} == {"u": "created", "u_last_day": "unchanged", "u_last_week": "unchanged"}
    assert {r.view_name: r.n_rows for r in catalog.count_catalog_views(spark, third, "cat1").collect()}["t"] == 1


def test_views_give_what_the_frames_give(spark, landed, tmp_path):
    structure = learn(spark, DOCS)
    catalog.sync_views(spark, f"parquet.`{landed}`", structure, str(tmp_path / "views"), "cat2", datetime(2024, 1, 2), on_clash="suffix")
    for event_type in ("t", "u"):
        for scope, name in (("all", event_type), ("week", f"{event_type}_last_week")):
            frame = views.flatten_typed(read_landed_events(spark, landed), structure, event_type, scope, datetime(2024, 1, 2), on_clash="suffix")
            view = spark.table(f"cat2.{name}")
            assert view.columns == frame.columns and [tuple(r) for r in view.collect()] == [tuple(r) for r in frame.collect()]
    plan = spark.table("cat2.t")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rowkey,T-0)" in plan


def test_one_bad_type_leaves_the_others(spark, landed, tmp_path):
    documents = [{"eventType": "good", "v": 1}, {"eventType": "bad", "a_b": 1, "a": {"b": 2}}]
    result, failed = catalog.sync_views(spark, f"parquet.`{landed}`", learn(spark, documents), str(tmp_path / "views"), "cat3")
    assert set(failed) == {"bad"} and {r.event_type for r in result.collect()} == {"good"}


def test_zone_map_counts_5000_types(spark, tmp_path):
    """One scan of files that some range cuts; whole zones are counted without reading them."""
    path, n = str(tmp_path / "landed"), 40_000
    rows = spark.range(n).select(F.concat(F.lit("K"), (F.col("id") % 5000).cast("string"), F.lit("-"), (F.lit(1_700_000_000) + F.col("id") * 20).cast("string"), F.lit("-x")).alias("rowkey"), F.lit("{}").alias("json"))
    hot = spark.range(20_000).select(F.concat(F.lit("HOT-"), (F.lit(1_700_000_000) + F.col("id")).cast("string")).alias("rowkey"), F.lit("{}").alias("json"))
    odd = spark.createDataFrame([("K1-X-1700000000", "{}"), ("nodash", "{}"), ("K1-9", "{}")], "rowkey string, json string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or so little data is one file
    try:
        write_landed_events(rows.unionByName(hot).unionByName(odd), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    types = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("event_type")).unionByName(spark.createDataFrame([("hot",), ("none",), ("k1-x",)], "event_type string"))
    as_of = datetime.fromtimestamp(1_700_000_000 + 604_800 + 10_000)
    got = {(r.event_type, r.scope): r.n_rows for r in range_counts(spark, path, types, ["all", "week"], as_of).collect()}
    assert len(got) == 2 * 5003 and got["none", "all"] == 0 and got["hot", "all"] == 20_000 and got["hot", "week"] == 10_000 and got["k1-x", "all"] == 1
    assert all(got[f"k{i}", "all"] == 8 for i in range(5000))
    want = {i: sum(20 * j >= 10_000 for j in range(i, n, 5000)) for i in range(0, 5000, 7)}
    assert all(got[f"k{i}", "week"] == w for i, w in want.items())
    # a range over the whole of a type with many files opens none of them
    assert boundary_files(_touched(spark, path, key_ranges(types.where("event_type = 'hot'"), ["all"]))) == []
    cut = boundary_files(_touched(spark, path, key_ranges(types.where("event_type = 'hot'"), ["week"], as_of)))
    assert len(cut) <= 1 and zones(spark, path).select("file").distinct().count() > 4
    assert read_landed_events(spark, path).count() == n + 20_003
