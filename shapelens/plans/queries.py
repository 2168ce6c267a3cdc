"""The registered queries: one per operator, each over whole test tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelens.functions import messages as m
from shapelens.functions.json_types import types_in
from shapelens.functions.naming import rowkey_timestamp
from shapelens.operators import catalog, drift, ledger, lineage, reports, views, warehouse
from shapelens.operators.avro import avro_paths
from shapelens.operators.decode import classify_events, decode_messages, distinct_events, distinct_positions, split_broken, split_invalid
from shapelens.operators.paths import count_shapes, event_structures, json_paths, paths_of_shapes, structures_of_shapes
from shapelens.operators.structure import from_registry, merge_structures, structure_lineage
from shapelens.plans import inputs
from shapelens.plans.analysis import classify, learn_structures
from shapelens.session import configure, shared_dir, sized
from shapelens.sources import landed, offsets, registry, topics
from shapelens.streaming.structures import latest_structures, stream_shapes, stream_structures

AS_OF = datetime(2024, 1, 31)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _joined(column: str) -> Column:
    return F.array_join(F.array_sort(column), "|").alias(column)


def _dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_events(decode_messages(inputs.dirty_messages(spark, sf_dir)))


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/query-{uuid.uuid4().hex}"


def _landed_table(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The rows written as a landed table and read back, so that key ranges reach the scan."""
    path = _scratch(spark)
    landed.write_landed_events(rows, path)
    return landed.read_landed_events(spark, path)


def _shipment_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn_structures(inputs.shipment_messages(spark, sf_dir))


# --- sources and sinks ------------------------------------------------------------------------------------------

@query
def s1_select_topics(spark, sf_dir):
    return topics.select_topics(inputs.dirty_messages(spark, sf_dir))


@query
def s2a_sample_topics(spark, sf_dir):
    return topics.sample_topics(inputs.dirty_messages(spark, sf_dir), 100).select(
        "topic", "partition", "offset", F.md5("value").alias("digest"))


@query
def s2b_sample_topics_per_partition(spark, sf_dir):
    return topics.sample_topics(inputs.dirty_messages(spark, sf_dir), 100, per_partition=True).select(
        "topic", "partition", "offset", F.md5("value").alias("digest"))


@query
def s3_topic_partition_count(spark, sf_dir):
    return topics.topic_partition_count(inputs.dirty_messages(spark, sf_dir))


@query
def s5_read_landed_events(spark, sf_dir):
    path = _scratch(spark)
    landed.write_landed_events(inputs.landed_events(spark, sf_dir), path)
    return landed.read_landed_events(spark, path).select("rowkey", F.md5("json").alias("digest"))


@query
def s6_schema_registry_lookup(spark, sf_dir):
    decoded = decode_messages(inputs.avro_messages(spark, sf_dir), inputs.schema_registry(spark, sf_dir))
    return decoded.select("offset", "schema_hash", "broken_reason", F.sha2("schema_json", 256).alias("schema_digest"))


@query
def s6_hot_schema_lookup(spark, sf_dir):
    """The registry taken for too large to broadcast, and a third of the customers sharing one hash."""
    customers = inputs.table(spark, sf_dir, "customer")
    key, text = F.col("c_custkey"), inputs.schema_text()
    hot = F.when(key % 3 == 0, F.md5(F.lit("hot"))).when(key % 3 == 1, F.md5(text)).otherwise(F.md5(F.concat(F.lit("x"), key.cast("string"))))
    messages = customers.select(F.lit("accounts").alias("topic"), (key % 4).cast("int").alias("partition"), key.alias("offset"), hot.alias("schema_hash"))
    schemas = inputs.schema_registry(spark, sf_dir).unionByName(spark.range(1).select(F.md5(F.lit("hot")).alias("schema_hash"), F.lit('{"type":"hot"}').alias("schema_json")))
    found = registry.schema_registry_lookup(messages, schemas, small=False)
    return found.select("offset", "schema_hash", F.sha2("schema_json", 256).alias("schema_digest"))


@query
def s6_registry_from_base64(spark, sf_dir):
    """A key-value export with base64 texts becomes the registry."""
    export = inputs.schema_registry(spark, sf_dir).select(
        F.concat(F.lit("schemas/"), "schema_hash").alias("key"), F.base64(F.col("schema_json").cast("binary")).alias("value"))
    return registry.registry_from_base64(export).select("schema_hash", F.sha2("schema_json", 256).alias("schema_digest"))


@query
def s7_write_samples(spark, sf_dir):
    path = _scratch(spark)
    valid, _ = split_invalid(_dirty(spark, sf_dir))
    registry.write_samples(distinct_events(valid, ["event_type"]), path, 10)
    samples = spark.read.text(path)
    return samples.select("event_type", F.get_json_object("value", "$.id").cast("bigint").alias("id"))


@query
def s8_structure_registry(spark, sf_dir):
    """Two runs, of which the second is the one that readers see."""
    path, structure = _scratch(spark), _shipment_structure(spark, sf_dir)
    registry.write_structure_registry(structure.where("false"), path, "9")
    registry.write_structure_registry(structure, path, "10")
    saved = registry.read_structure_registry(spark, path)
    return saved.select("event_type", "path", "optional", "n_trees", "is_leaf")


@query
def s9_create_views(spark, sf_dir):
    """All types' views in the catalog in all scopes, the rows of each counted through it, and what a second run creates."""
    structure = learn_structures(inputs.messages(spark, sf_dir))
    path, registry_path = _scratch(spark), _scratch(spark)
    landed.write_landed_events(inputs.landed_events(spark, sf_dir), path)
    catalog.sync_views(spark, f"parquet.`{path}`", structure, registry_path, "shapelens", AS_OF)
    again, _ = catalog.sync_views(spark, f"parquet.`{path}`", structure, registry_path, "shapelens", AS_OF)
    return catalog.count_catalog_views(spark, again, "shapelens").join(again.select("view_name", "status"), "view_name")


@query
def s11_write_reports(spark, sf_dir):
    path = _scratch(spark)
    reports.write_reports({"topics": reports.topic_report(_dirty(spark, sf_dir))}, path)
    return spark.read.parquet(f"{path}/topics").select("topic", "n_events", "n_invalid", "n_broken", "is_consistent")


@query
def s11_schema_report(spark, sf_dir):
    """Every schema that account messages carry."""
    found = lineage.schema_report(inputs.schema_registry(spark, sf_dir), _accounts(spark, sf_dir))
    return found.select("schema_hash", "name", "full_name", _joined("versions"), _joined("event_types"), "n_messages", "n_nodes")


@query
def s11_structure_report(spark, sf_dir):
    """Structures of shipments, of events and merged."""
    events = classify_events(decode_messages(inputs.shipment_messages(spark, sf_dir)))
    shapes = count_shapes(events, ["event_type"])
    found = lineage.structure_report(structures_of_shapes(shapes), merge_structures(paths_of_shapes(shapes)))
    return found.select("event_type", "source", "n_events", "n_nodes")


@query
def s2_sample_by_offset_index(spark, sf_dir):
    """Samples of a message table that read the files of the index only, per topic and per partition."""
    path = _scratch(spark)
    offsets.write_messages(inputs.dirty_messages(spark, sf_dir), path)
    return offsets.sample_messages(spark, path, 100).withColumn("per_partition", F.lit(False)).unionByName(
        offsets.sample_messages(spark, path, 100, per_partition=True).withColumn("per_partition", F.lit(True))).select(
        "per_partition", "topic", "partition", "offset", F.md5("value").alias("digest"))


@query
def s3_partitions_by_offset_index(spark, sf_dir):
    """Partitions of each topic with the empty ones: eight are known of each, and of a topic without messages."""
    path, rows = _scratch(spark), inputs.dirty_messages(spark, sf_dir)
    known = rows.select("topic").distinct().unionByName(spark.createDataFrame([("silent",)], "topic string")).select("topic", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("partition"))
    offsets.write_messages(rows, path, known)
    return offsets.partition_counts(offsets.offsets(spark, path))


# --- decoding ---------------------------------------------------------------------------------------------------

@query
def f1_is_avro_message(spark, sf_dir):
    rows = inputs.dirty_messages(spark, sf_dir)
    return rows.select("topic", "offset", m.is_avro_message(F.col("value")).alias("is_avro"))


@query
def f2_schema_hash_of(spark, sf_dir):
    return inputs.dirty_messages(spark, sf_dir).select(
        "topic", "offset", m.schema_hash_of(F.col("value")).alias("schema_hash"))


@query
def f4_decode_messages(spark, sf_dir):
    decoded = decode_messages(inputs.dirty_messages(spark, sf_dir))
    return decoded.select(
        "topic", "offset", F.col("event").isNotNull().alias("decoded"),
        F.try_variant_get("event", "$.props.k", "bigint").alias("k"))


@query
def f5_split_broken(spark, sf_dir):
    _, broken = split_broken(decode_messages(inputs.dirty_messages(spark, sf_dir)))
    return broken.select("topic", "offset", "broken_reason")


@query
def f6_split_invalid(spark, sf_dir):
    _, invalid = split_invalid(_dirty(spark, sf_dir))
    return invalid.select("topic", "offset", "invalid_reason")


@query
def f7_rowkey_range_all(spark, sf_dir):
    return landed.rowkey_range(_landed_table(spark, inputs.landed_events(spark, sf_dir)), "click").select("rowkey", F.md5("json").alias("digest"))


@query
def f8_rowkey_range_week(spark, sf_dir):
    return landed.rowkey_range(_landed_table(spark, inputs.landed_events(spark, sf_dir)), "purchase", "week", AS_OF).select(
        "rowkey", F.md5("json").alias("digest"))


# --- projections ------------------------------------------------------------------------------------------------

@query
def p1_extract_envelope(spark, sf_dir):
    decoded = decode_messages(inputs.dirty_messages(spark, sf_dir))
    fields = {"id": m.FIELD_ID, "timestamp_text": m.FIELD_TIMESTAMP, "event_type": m.FIELD_EVENT_TYPE, "version": m.FIELD_VERSION}
    return decoded.select("topic", "offset", *[m.field_text(F.col("event"), f).alias(c) for c, f in fields.items()])


@query
def p2_timestamp_unit(spark, sf_dir):
    return _dirty(spark, sf_dir).select("topic", "offset", "timestamp_unit")


@query
def p3_rowkey_timestamp(spark, sf_dir):
    rows = inputs.landed_events(spark, sf_dir)
    return rows.select("rowkey", rowkey_timestamp(F.col("rowkey")).cast("string").alias("row_time"))


def _path_rows(paths: DataFrame) -> DataFrame:
    return paths.select(
        "event_type", "path", F.array_join(types_in("mask"), "|").alias("json_types"),
        F.array_join(types_in("mask", item=True), "|").alias("item_types"), "n_trees")


@query
def p4_json_paths(spark, sf_dir):
    return _path_rows(json_paths(classify_events(decode_messages(inputs.shipment_messages(spark, sf_dir)))))


@query
def p4_json_paths_of_dirty_messages(spark, sf_dir):
    return _path_rows(json_paths(_dirty(spark, sf_dir)))


@query
def p5_avro_paths(spark, sf_dir):
    return avro_paths(inputs.schema_registry(spark, sf_dir)).select(
        "schema_hash", "path", "optional", _joined("avro_types"), _joined("avro_union_types"), _joined("avro_enum_symbols"),
        _joined("avro_item_types"), _joined("avro_item_names"), _joined("avro_map_value_types"))


@query
def p6_flatten_untyped(spark, sf_dir):
    view = views.flatten_untyped(_landed_table(spark, inputs.landed_shipments(spark, sf_dir)), _shipment_structure(spark, sf_dir), "shipment")
    return view.select(
        "row_key", F.col("row_timestamp").cast("string").alias("row_timestamp"), F.col("id").cast("string").alias("id"),
        F.col("item_part").cast("bigint").alias("item_part"), F.col("item_supplier_id").cast("bigint").alias("item_supplier_id"),
        F.col("price").cast("double").alias("price"), F.to_json("codes").alias("codes"),
        F.try_variant_get("note", "$", "string").alias("note"))


@query
def p7_flatten_typed(spark, sf_dir):
    view = views.flatten_typed(_landed_table(spark, inputs.landed_shipments(spark, sf_dir)), _shipment_structure(spark, sf_dir), "shipment")
    return view.select(
        "rowkey", "eventType", "id", "item_part", "item_supplier_id", "note", "price",
        F.col("timestamp").cast("string").alias("event_time"), F.array_join("codes", "|").alias("codes"),
        F.size("charges").alias("n_charges"), F.array_join(F.col("charges.kind"), "|").alias("kinds"),
        F.aggregate(F.col("charges.rate"), F.lit(0.0), lambda a, r: a + r).alias("rate_sum"))


@query
def p8_cast_event_timestamp(spark, sf_dir):
    valid, _ = split_invalid(_dirty(spark, sf_dir))
    return valid.select("topic", "offset", m.event_timestamp(F.col("timestamp_text")).cast("string").alias("event_time"))


@query
def p11_explode_arrays(spark, sf_dir):
    return views.explode_arrays(
        _landed_table(spark, inputs.landed_shipments(spark, sf_dir)), _shipment_structure(spark, sf_dir), "shipment", "charges")


@query
def p11_explode_scalar_arrays(spark, sf_dir):
    return views.explode_arrays(
        _landed_table(spark, inputs.landed_shipments(spark, sf_dir)), _shipment_structure(spark, sf_dir), "return", "codes")


@query
def p12_json_tuple_view(spark, sf_dir):
    return views.json_tuple_view(_landed_table(spark, inputs.landed_shipments(spark, sf_dir)), _shipment_structure(spark, sf_dir), "return")


@query
def p13_warehouse_columns(spark, sf_dir):
    return warehouse.warehouse_columns(_shipment_structure(spark, sf_dir))


@query
def p14_load_mapping(spark, sf_dir):
    return warehouse.load_mapping(_shipment_structure(spark, sf_dir))


@query
def p15_load_warehouse_increment(spark, sf_dir):
    rows = warehouse.load_warehouse_increment(
        _landed_table(spark, inputs.landed_shipments(spark, sf_dir)), _shipment_structure(spark, sf_dir), "shipment", "SHIPMENT-0900000000", 7)
    return rows.select(
        "rowkey", "meta_CreateProcessID", "codes", "eventType", "id", "item_part", "item_supplier_id", "note",
        F.col("price").cast("string").alias("price"), "timestamp")


@query
def p15_next_mark(spark, sf_dir):
    """Mark of each type after a load of everything: a pushed key range over a landed table."""
    rows = _landed_table(spark, inputs.landed_shipments(spark, sf_dir))
    marks = [(t.upper(), warehouse.next_mark(rows, t)) for t in ("return", "shipment")]
    return spark.createDataFrame(marks, "event_type string, mark string")


@query
def p15_append_increment(spark, sf_dir):
    """Two increments appended to one table, the second from the mark of the first."""
    path, rows, structure = _scratch(spark), _landed_table(spark, inputs.landed_shipments(spark, sf_dir)), _shipment_structure(spark, sf_dir)
    early = rows.where("rowkey < 'RETURN-0800000000'")
    mark = warehouse.append_increment(early, structure, "return", path, run_id=1)
    mark = warehouse.append_increment(rows, structure, "return", path, mark, run_id=2)
    loaded = spark.read.parquet(path)
    return loaded.select("rowkey", F.col("meta_CreateProcessID").alias("run"), "id", F.lit(mark).alias("mark"))


@query
def p15_load_ledger(spark, sf_dir):
    """Two loads and one of late rows. Nobody carries a mark: what landed early lacks some rows, which the third load finds."""
    path, rows, structure = _scratch(spark), _landed_table(spark, inputs.landed_shipments(spark, sf_dir)), _shipment_structure(spark, sf_dir)
    early = rows.where("rowkey < 'RETURN-0800000000' and right(rowkey, 1) <> '3'")
    ledger.load(early, structure, "return", path, run_id=1)
    ledger.load(early, structure, "return", path, run_id=1)  # again: replaces its own rows
    ledger.load(rows, structure, "return", path, run_id=2)
    ledger.load_late(rows, structure, "return", path, run_id=3)
    runs = ledger.ledger(spark, path).select(F.col("run_id").alias("run"), "n_rows")
    return ledger.loaded(spark, path, "return").select("rowkey", F.col("meta_CreateProcessID").alias("run"), "id", F.col("price").cast("string").alias("price")).join(runs, "run")


# --- aggregations -----------------------------------------------------------------------------------------------

@query
def a1_distinct_events(spark, sf_dir):
    return distinct_positions(inputs.dirty_messages(spark, sf_dir)).select("topic", "partition", "offset", "n_copies")


@query
def a1_distinct_events_of_type(spark, sf_dir):
    valid, _ = split_invalid(_dirty(spark, sf_dir))
    return distinct_positions(valid, ["event_type"]).select("event_type", "topic", "offset")


@query
def a2_events_by_type(spark, sf_dir):
    return reports.events_by_type(_dirty(spark, sf_dir)).select("event_type", "n_events", _joined("topics"))


@query
def a3_schema_versions(spark, sf_dir):
    return reports.event_type_report(_dirty(spark, sf_dir)).select("event_type", _joined("versions"))


@query
def a4_avro_mix(spark, sf_dir):
    return reports.event_type_report(_dirty(spark, sf_dir)).select(
        "event_type", F.size("avro_flags").alias("n_flags"), F.size("schema_hashes").alias("n_schemas"))


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(inputs.account_messages(spark, sf_dir), inputs.schema_registry(spark, sf_dir), inputs.json_body)


@query
def a4_avro_mix_of_accounts(spark, sf_dir):
    """Types whose messages are JSON, Avro, or both."""
    return reports.event_type_report(_accounts(spark, sf_dir)).select(
        "event_type", "n_events", F.array_join(F.transform("avro_flags", lambda f: f.cast("string")), "|").alias("avro_flags"),
        F.size("schema_hashes").cast("bigint").alias("n_schemas"), "is_consistent")


@query
def a9_topic_report_of_accounts(spark, sf_dir):
    return reports.topic_report(_accounts(spark, sf_dir)).select(
        "topic", "n_events", "n_invalid", "n_undecoded", "n_broken", _joined("event_types"), "is_consistent")


@query
def a9_topic_report_of_undecoded_accounts(spark, sf_dir):
    """Without a decoder, known Avro messages are neither broken nor invalid."""
    events = classify_events(decode_messages(inputs.account_messages(spark, sf_dir), inputs.schema_registry(spark, sf_dir)))
    return reports.topic_report(events).select("topic", "n_events", "n_invalid", "n_undecoded", "n_broken")


@query
def f6_undecoded(spark, sf_dir):
    events = classify_events(decode_messages(inputs.account_messages(spark, sf_dir), inputs.schema_registry(spark, sf_dir)))
    return events.select("topic", "offset", "broken_reason", "invalid_reason", "undecoded", "event_type")


@query
def a7_learned_from_accounts(spark, sf_dir):
    """Structure of accounts: the events' own paths and those of the Avro schemas that their messages carry."""
    learned = learn_structures(inputs.account_messages(spark, sf_dir), inputs.schema_registry(spark, sf_dir), decoder=inputs.json_body)
    return learned.select("event_type", "path", "n_trees", _joined("avro_types"), F.array_join("json_types", "|").alias("json_types"))


@query
def a5_timestamp_units(spark, sf_dir):
    return reports.event_type_report(_dirty(spark, sf_dir)).select("event_type", _joined("timestamp_units"))


@query
def a6_distinct_structures(spark, sf_dir):
    events = classify_events(decode_messages(inputs.shipment_messages(spark, sf_dir)))
    return event_structures(events).select(
        "event_type", F.array_join(F.transform("nodes", lambda n: F.concat(n.path, F.lit(":"), n.mask.cast("string"))), "|").alias("nodes"),
        "n_events")


@query
def a7_merge_structures(spark, sf_dir):
    return _shipment_structure(spark, sf_dir).select("event_type", "path", "parent_path", "name", "depth", "optional", "n_trees")


@query
def a7_merge_with_avro(spark, sf_dir):
    """Avro trees of all registered schemas under one type, merged as the schemas of its messages would be."""
    schemas = avro_paths(inputs.schema_registry(spark, sf_dir))
    trees = schemas.select(F.lit("account").alias("event_type"), "*", F.lit(0).alias("mask"), F.lit(1).cast("bigint").alias("n_trees"))
    return merge_structures(trees).select(
        "event_type", "path", "optional", "n_trees", "is_array", "primitive", "item_primitive", _joined("avro_enum_symbols"))


@query
def a7_open_keys(spark, sf_dir):
    """Structure of events that use ids as keys: one path for all keys of an object."""
    events = classify_events(decode_messages(inputs.keyed_messages(spark, sf_dir)))
    structure = merge_structures(json_paths(events, open_from=50), open_from=50)
    return structure.select("event_type", "path", F.array_join("json_types", "|").alias("json_types"), "n_trees", "optional", "is_map", "is_leaf")


@query
def a8_resolve_primitive(spark, sf_dir):
    return _shipment_structure(spark, sf_dir).where("is_leaf").select("event_type", "path", "primitive", "item_primitive")


@query
def a9_topic_report(spark, sf_dir):
    return reports.topic_report(_dirty(spark, sf_dir)).select(
        "topic", "n_events", "n_invalid", "n_without_type", "n_without_timestamp", "n_broken", "n_null",
        _joined("event_types"), "n_partitions", "is_consistent")


@query
def a10_event_type_report(spark, sf_dir):
    return reports.event_type_report(_dirty(spark, sf_dir)).select(
        "event_type", "n_events", _joined("topics"), _joined("versions"), _joined("timestamp_units"), "is_consistent",
        F.array_join("messages", "|").alias("messages"))


@query
def a11_day_count(spark, sf_dir):
    """Messages to structure to typed views over a landed table to rows of the last day: the whole path."""
    rows = _landed_table(spark, inputs.landed_events(spark, sf_dir))
    names, _ = views.create_all_views(spark, rows, learn_structures(inputs.messages(spark, sf_dir)), AS_OF)
    return views.count_views(spark, names, "day")


@query
def a11_range_counts(spark, sf_dir):
    """Every part as an event type, counted in two scopes: by the zone map, and in the files that a range cuts."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    rowkey = F.concat(F.lit("PART"), F.col("l_partkey").cast("string"), F.lit("-"), F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("string"),
                      F.lit("-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    path = _scratch(spark)
    landed.write_landed_events(lines.where("unix_seconds(cast(l_shipdate as timestamp)) >= 100000000").select(rowkey.alias("rowkey"), F.lit("{}").alias("json")), path)
    types = inputs.table(spark, sf_dir, "part").select(F.concat(F.lit("part"), F.col("p_partkey").cast("string")).alias("event_type"))
    return landed.range_counts(spark, path, types, ["all", "week"], datetime(1996, 6, 1))


@query
def a12_pivot_parameters(spark, sf_dir):
    customers = inputs.table(spark, sf_dir, "customer")
    pairs = {
        "TARGETNAME": F.lower("c_mktsegment"), "EVENTTYPE": F.concat(F.upper("c_mktsegment"), F.lit("-0")),
        "SOURCENAME": F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")), "OTHER": F.lit("unused"),
    }
    parameters = customers.select(F.col("c_name").alias("param_filter"), F.explode(F.create_map(
        *[c for k, v in pairs.items() for c in (F.lit(k), v)])).alias("parameter_key", "parameter_value"))
    return warehouse.pivot_parameters(
        parameters, {"TARGETNAME": "targetname", "SOURCENAME": "sourcename", "DELTATYPE": "deltatype", "EVENTTYPE": "strvalue"})


@query
def a13_too_few_events(spark, sf_dir):
    """Customers' names serve as announced topics; most have received nothing."""
    events = _dirty(spark, sf_dir)
    announced = inputs.table(spark, sf_dir, "customer").select(F.concat(F.lit("shop_"), F.col("c_custkey").cast("string")).alias("topic"))
    return reports.too_few_events(reports.event_type_report(events), reports.topic_report(events), announced)


@query
def w2_example_event(spark, sf_dir):
    return reports.example_event(_dirty(spark, sf_dir)).select("event_type", "topic", "partition", "offset")


@query
def u1_union_of_sources(spark, sf_dir):
    merged = merge_structures(
        json_paths(classify_events(decode_messages(inputs.messages(spark, sf_dir)))),
        json_paths(classify_events(decode_messages(inputs.shipment_messages(spark, sf_dir)))))
    return merged.groupBy("event_type").agg(F.count("*").alias("n_paths"), F.max("n_trees").alias("n_trees"))


# --- drift ------------------------------------------------------------------------------------------------------

def _drift(spark, sf_dir):
    now = drift.column_list(learn_structures(inputs.dirty_messages(spark, sf_dir)))
    before = drift.column_list(learn_structures(inputs.messages(spark, sf_dir)))
    return drift.view_drift(now, before)


@query
def d1_view_drift(spark, sf_dir):
    return _drift(spark, sf_dir).select("event_type", "status", _joined("added"), _joined("removed"), _joined("retyped"))


@query
def d2_schema_conflicts(spark, sf_dir):
    """The registry keyed by market segment instead of by content: every segment holds many schemas."""
    customers = inputs.table(spark, sf_dir, "customer")
    wrong = customers.select(F.md5("c_mktsegment").alias("schema_hash"), inputs.schema_text().alias("schema_json"))
    return registry.schema_conflicts(wrong)


@query
def d3_change_log(spark, sf_dir):
    """All five inputs: drift, both reports, what got too few events, and a registry with conflicts."""
    events = _dirty(spark, sf_dir)
    topics_seen, types = reports.topic_report(events), reports.event_type_report(events)
    announced = spark.createDataFrame([("silent",), ("shop_0",)], "topic string")
    customers = inputs.table(spark, sf_dir, "customer")
    conflicts = registry.schema_conflicts(customers.select(F.md5("c_mktsegment").alias("schema_hash"), inputs.schema_text().alias("schema_json")))
    return drift.change_log(_drift(spark, sf_dir), topics_seen, types, reports.too_few_events(types, topics_seen, announced), conflicts)


@query
def d4_structure_lineage(spark, sf_dir):
    events = classify_events(decode_messages(inputs.shipment_messages(spark, sf_dir)))
    structures = event_structures(events).select("event_type", "structure_id", F.lit("EVENT").alias("source"))
    return structure_lineage(structures).groupBy("event_type").agg(F.count("*").alias("n_sources"))


@query
def d4_lineage_over_runs(spark, sf_dir):
    """Three runs over a third of the line items each: what fed the structures of the last run, by the run that had it first."""
    edges, before = None, None
    for run in range(3):
        messages = inputs.shipment_messages(spark, sf_dir).where(F.col("offset") % 3 == run)
        shapes = count_shapes(classify_events(decode_messages(messages)), ["event_type"])
        paths = paths_of_shapes(shapes)
        merged = sized(merge_structures(*([paths] if before is None else [paths, from_registry(before)])))
        new = lineage.lineage_edges(lineage.structure_report(structures_of_shapes(shapes), merged), run, before)
        edges, before = new if edges is None else edges.unionByName(new), merged
    last = lineage.merged_trees(before).select("event_type", F.col("structure_id").alias("merged_id"))
    return lineage.lineage(edges).join(last, ["event_type", "merged_id"]).groupBy("event_type", "source", "run").agg(F.count("*").alias("n_structures"))


# --- streaming --------------------------------------------------------------------------------------------------

#: Rows of a file that a stream reads.
STREAM_FILE_ROWS = 500_000


def _files(rows: DataFrame, least: int) -> int:
    """Files for the rows of a stream: a multiple of `least`, so that no task's share grows with the rows."""
    return least * max(1, math.ceil(rows.count() / (least * STREAM_FILE_ROWS)))


@query
def r1_stream_structures(spark, sf_dir):
    """Shipments as a stream of files, merged batch by batch."""
    root = _scratch(spark)
    rows = inputs.shipment_messages(spark, sf_dir)
    files = _files(rows, 24)
    rows.repartition(files, "offset").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files // 3).parquet(f"{root}/in")
    stream_structures(stream, f"{root}/registry", f"{root}/checkpoint", availableNow=True).awaitTermination()
    return latest_structures(spark, f"{root}/registry").select("event_type", "path", "optional", "n_trees")


@query
def r1_stream_shapes(spark, sf_dir):
    """The same with counts as the stream's state, over a restart: half of the files come after the first run has ended."""
    root = _scratch(spark)
    rows = inputs.shipment_messages(spark, sf_dir)
    files = _files(rows, 4)
    for half in range(2):
        rows.where(F.col("offset") % 2 == half).repartition(files, "offset").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in")
        stream_shapes(stream, f"{root}/registry", f"{root}/checkpoint", availableNow=True).awaitTermination()
    return latest_structures(spark, f"{root}/registry").select("event_type", "path", "optional", "n_trees")
