"""One whole run: messages to reports, structures, views, counts and changes."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelens.functions.messages import message_digest, parse_json

from shapelens.operators import drift, lineage, reports
from shapelens.operators.avro import avro_paths, avro_structures
from shapelens.operators.decode import avro_available, classify_events, decode_avro, decode_messages, distinct_events
from shapelens.operators.open_keys import open_of
from shapelens.operators.paths import count_shapes, json_paths, paths_of_shapes, structures_of_shapes
from shapelens.operators.structure import from_registry, merge_structures
from shapelens.operators.views import count_views, create_all_views
from shapelens.session import sized
from shapelens.sources.registry import read_structure_registry, schema_conflicts, write_samples, write_structure_registry
from shapelens.sources.snapshots import current, last_number, write_snapshot
from shapelens.sources.topics import topic_selected


def classify(messages: DataFrame, registry: DataFrame | None = None, decoder: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Decoded and classified messages. Avro bodies are decoded where a decoder is given or the session has spark-avro."""
    decoded = decode_messages(messages, registry)
    if registry is not None and (decoder is not None or avro_available(messages.sparkSession)):
        decoded = decode_avro(decoded, decoder=decoder)
    return classify_events(decoded)


def structures_of(events: DataFrame, registry: DataFrame | None = None, previous: DataFrame | None = None,
                  sticky: bool = False, used: DataFrame | None = None, shapes: DataFrame | None = None) -> DataFrame:
    """Merged structure of classified events, the Avro schemas they use and the last run.

    Which schema belongs to which event type is taken from the decoded events; where bodies stay undecoded, `used`
    says it: `(event_type, schema_hash)`. `shapes` are the events' shapes, if they have been counted already.
    """
    known = None if previous is None else open_of(previous)
    sources = [json_paths(events, known=known) if shapes is None else paths_of_shapes(shapes, known=known)]
    if registry is not None:
        seen = events.where("is_avro and event_type is not null").select("event_type", "schema_hash").distinct()
        if used is not None:
            seen = seen.union(used.select("event_type", "schema_hash")).distinct()
        seen = sized(seen)
        in_use = registry.join(seen.select("schema_hash").distinct(), "schema_hash", "left_semi").groupBy("schema_hash").agg(F.min("schema_json").alias("schema_json"))
        sources.append(avro_structures(avro_paths(in_use), seen))
    if previous is not None:
        sources.append(from_registry(previous))
    return merge_structures(*sources, sticky=sticky)


def learn_structures(messages: DataFrame, registry: DataFrame | None = None, previous: DataFrame | None = None,
                     sticky: bool = False, used: DataFrame | None = None, decoder: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """`structures_of` the messages."""
    return structures_of(classify(messages, registry, decoder), registry, previous, sticky, used)


def analyse(messages: DataFrame, landed: DataFrame, registry: DataFrame | None = None, previous: DataFrame | None = None,
            as_of: datetime | None = None, whitelist: list[str] | None = None, used: DataFrame | None = None,
            decoder: Callable[[Column, Column], Column] | None = None, run: int = 0, store: str | None = None) -> dict[str, DataFrame]:
    """Reports by name: `topics, event_types, schemas, structures, structure_sources, edges, day_counts, drift, changes`.
    Also creates the session views.

    The source is read once: the classified messages, without their bytes, are written to the shared folder, and every
    report reads what it needs of them. A type whose views cannot be built is a warning in `changes`; the others go on.

    With `store`, a folder, runs hang together by themselves: the structures of the run before are read from it unless
    `previous` is given, and samples, the merged structures and the lineage edges of this run are written to it.
    """
    spark = messages.sparkSession
    after = last_number(spark, f"{store}/structures") if store else None
    if store and previous is None:
        previous = read_structure_registry(spark, f"{store}/structures")
    chosen = messages.where(topic_selected(F.col("topic"), whitelist))
    events = stored(classify(chosen, registry, decoder))
    topics, types = sized(reports.topic_report(events, values=False)), sized(reports.event_type_report(events, values=False))
    shapes = count_shapes(events, ["event_type"])
    structure = sized(structures_of(events, registry, previous, used=used, shapes=shapes))
    schemas = sized(lineage.schema_report(registry, events)) if registry is not None else None
    sources = sized(lineage.structure_report(structures_of_shapes(shapes), structure, schemas))
    edges = sized(lineage.lineage_edges(sources, run, previous))
    names, failed = create_all_views(spark, landed, structure, as_of)
    columns = drift.column_list(structure)
    before = drift.column_list(previous) if previous is not None else columns.where("false")
    changed = sized(drift.view_drift(columns, before))
    conflicts = schema_conflicts(registry) if registry is not None else None
    problems = spark.createDataFrame([(f"event type {name}", reason) for name, reason in failed.items()], "subject string, message string")
    few = reports.too_few_events(types, topics).unionByName(problems)
    if store:
        write_samples(distinct_events(events.where("event_type is not null"), ["event_type"], "digest"), f"{store}/samples")
        known = current(spark, f"{store}/edges")
        others = known.read(spark).where(F.col("run") != run) if known else edges.where("false")
        write_snapshot(others.unionByName(edges), f"{store}/edges", str(run))
        write_structure_registry(structure, f"{store}/structures", str(run), after)
    made = {
        "topics": topics, "event_types": types, "structures": structure, "structure_sources": sources, "edges": edges,
        "day_counts": count_views(spark, names, "day"), "drift": changed,
        "changes": drift.change_log(changed, topics, types, few, conflicts),
    }
    return made if schemas is None else {**made, "schemas": schemas}


def stored(classified: DataFrame) -> DataFrame:
    """Classified events written once: the digest in place of the bytes, the JSON text in place of the parsed event."""
    narrow = classified.select(
        "topic", "partition", "offset", "is_avro", "schema_hash", "broken_reason", "invalid_reason", "undecoded", "event_type", "version",
        "timestamp_text", "timestamp_unit", message_digest(F.col("value")).alias("digest"),
        F.when(F.col("event_type").isNotNull(), F.col("event_text")).alias("event_text"))
    return sized(narrow).withColumn("event", parse_json(F.col("event_text")))
