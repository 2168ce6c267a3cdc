"""Consistency reports per topic and per event type.

Counting distinct events shuffles their digests, and nothing else per message. What messages carry beside (types,
versions, units, schemas, partitions) is counted per value, which collapses map-side; consistency follows from the
numbers of values, so no row grows with what message fields hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelens.functions.messages import message_digest, message_text
from shapelens.operators.decode import NO_EVENT_TYPE, NO_TIMESTAMP, NULL_MESSAGE, position
from shapelens.session import sized

ABSENT = "ABSENT"
UNDECODED = "body not decoded"


def digest_of(classified: DataFrame) -> Column:
    """Digest of a message: stored, or made from its bytes."""
    return F.col("digest") if "digest" in classified.columns else message_digest(F.col("value"))


def topic_event_types(classified: DataFrame) -> DataFrame:
    """`(topic, event_type, n_messages)`, however many types a topic has."""
    return classified.groupBy("topic", "event_type").agg(F.count("*").alias("n_messages")).where("event_type is not null")


def topic_report(classified: DataFrame, values: bool = True) -> DataFrame:
    """Per topic: distinct events, invalid and undecoded ones, broken messages, types, partitions, consistency and messages.

    With `values` the event types stand beside their number as an array; see `topic_event_types` for a table.
    """
    rows = classified.select(
        "topic", digest_of(classified).alias("digest"),
        F.coalesce("broken_reason", "invalid_reason", F.when(F.col("undecoded"), UNDECODED)).alias("reason"), F.col("broken_reason").isNotNull().alias("broken"))
    distinct = rows.groupBy("topic", "digest", "reason", "broken").agg(F.count("*").alias("copies"))
    readable = ~F.col("broken")
    undecoded = readable & (F.col("reason") == UNDECODED)
    invalid = readable & (F.col("reason") != UNDECODED)

    def total(condition: Column, amount: Column | int = 1) -> Column:
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0)).cast("bigint")

    counted = distinct.groupBy("topic").agg(
        total(readable).alias("n_events"), total(invalid).alias("n_invalid"),
        total(invalid & (F.col("reason") == NO_EVENT_TYPE)).alias("n_without_type"),
        total(invalid & (F.col("reason") == NO_TIMESTAMP)).alias("n_without_timestamp"),
        total(undecoded).alias("n_undecoded"),
        total(F.col("broken"), F.col("copies")).alias("n_broken"),
        total(F.col("reason") == NULL_MESSAGE, F.col("copies")).alias("n_null"),
    )
    partitions = classified.groupBy("topic", "partition").agg(F.lit(1).alias("one")).groupBy("topic").agg(F.count("*").cast("int").alias("n_partitions"))
    seen = sized(topic_event_types(classified))
    types = seen.groupBy("topic").agg(F.count("*").alias("n_types"), *([F.array_sort(F.collect_list("event_type")).alias("event_types")] if values else []))
    report = counted.join(partitions, "topic").join(types, "topic", "left").withColumn("n_types", F.coalesce("n_types", F.lit(0)))
    if values:
        report = report.withColumn("event_types", F.coalesce("event_types", F.array().cast("array<string>")))
    return report.select(
        "*", ((F.col("n_types") == 1) & (F.col("n_invalid") == 0) & (F.col("n_broken") == 0)).alias("is_consistent"),
        F.array_compact(F.array(
            F.when(F.col("n_invalid") > 0, "some events are invalid"),
            F.when(F.col("n_without_type") > 0, "some events have no type"),
            F.when(F.col("n_without_timestamp") > 0, "some events have no timestamp"),
            F.when(F.col("n_types") > 1, "the topic carries several event types"),
            F.when(F.col("n_broken") > F.col("n_null"), "some messages could not be read"),
            F.when(F.col("n_null") > 0, "some messages are empty (null)"),
        )).alias("messages"),
    )


def broken_messages(classified: DataFrame) -> DataFrame:
    """Every broken message with its text, one row each."""
    return classified.where("broken_reason is not null").select(
        "topic", "partition", "offset", "broken_reason", message_text(F.col("value")).alias("text"))


#: Attributes of an event type, in the order of the arrays below.
ATTRIBUTES = {"topic": "topics", "version": "versions", "timestamp_unit": "timestamp_units", "schema_hash": "schema_hashes", "is_avro": "avro_flags"}


def event_type_attributes(classified: DataFrame) -> DataFrame:
    """`(event_type, attribute, value, n_messages)`: what the messages of each type carry, however many values there are."""
    values = {"topic": F.col("topic"), "version": F.coalesce("version", F.lit(ABSENT)), "timestamp_unit": F.col("timestamp_unit"),
              "schema_hash": F.col("schema_hash"), "is_avro": F.col("is_avro").cast("string")}
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("attribute"), v.alias("value")) for a, v in values.items()])).alias("p")
    return classified.select("event_type", pairs).select("event_type", "p.*").groupBy("event_type", "attribute", "value").agg(
        F.count("*").alias("n_messages")).where("event_type is not null and value is not null")


def event_type_report(classified: DataFrame, values: bool = True) -> DataFrame:
    """Per event type: distinct events over all topics, number of topics, versions, units, schemas, consistency.

    With `values` the values stand beside their numbers as arrays, which are as long as there are values: for a field
    that every message fills anew take `event_type_attributes` instead.
    """
    events = classified.select("event_type", digest_of(classified).alias("digest")).groupBy("event_type", "digest").agg(F.lit(1).alias("one"))
    counted = events.where("event_type is not null").groupBy("event_type").agg(F.count("digest").alias("n_events"))
    seen = sized(event_type_attributes(classified))
    numbers = seen.groupBy("event_type").agg(
        *[F.count(F.when(F.col("attribute") == a, 1)).alias(f"n_{name}") for a, name in ATTRIBUTES.items()],
        F.coalesce(F.bool_or((F.col("attribute") == "timestamp_unit") & (F.col("value") == "SECONDS")), F.lit(False)).alias("has_seconds"))
    report = counted.join(numbers, "event_type")
    if values:
        sets = seen.groupBy("event_type").agg(
            *[F.array_sort(F.collect_list(F.when(F.col("attribute") == a, F.col("value")))).alias(name) for a, name in ATTRIBUTES.items()])
        report = report.join(sets.withColumn("avro_flags", F.transform("avro_flags", lambda f: f.cast("boolean"))), "event_type")
    consistent = ((F.col("n_avro_flags") == 1) & (F.col("n_schema_hashes") <= 1) & (F.col("n_versions") == 1)
                  & (F.col("n_timestamp_units") == 1) & ~F.col("has_seconds"))
    return report.select(
        "*", consistent.alias("is_consistent"),
        F.array_compact(F.array(
            F.when(F.col("n_events") < 2, "a single event says nothing about consistency"),
            F.when(F.col("n_versions") > 1, "several schema versions in use"),
            F.when(F.col("n_avro_flags") > 1, "Avro and JSON bodies side by side"),
            F.when(F.col("n_schema_hashes") > 1, "several Avro schemas in use"),
            F.when(F.col("n_timestamp_units") > 1, "timestamps in different units"),
            F.when(F.col("has_seconds"), "timestamps count seconds"),
        )).alias("messages"),
    )


def events_by_type(classified: DataFrame) -> DataFrame:
    """Distinct events and source topics of each type."""
    return event_type_report(classified).select("event_type", "n_events", "topics")


def example_event(classified: DataFrame) -> DataFrame:
    """First event of each type by (topic, partition, offset)."""
    firsts = classified.groupBy("event_type", "topic").agg(F.min(position()).alias("first"))
    first = firsts.where("event_type is not null").groupBy("event_type").agg(
        F.min_by(F.struct("topic", "first"), "topic").alias("pick"))
    picks = sized(first.select(F.col("pick.topic").alias("topic"), F.col("pick.first").alias("_place")))
    places = picks.select("topic", "_place.partition", "_place.offset")
    return classified.join(places, ["topic", "partition", "offset"], "left_semi").select(*classified.columns)


def too_few_events(event_types: DataFrame, topics_seen: DataFrame, topics: DataFrame | None = None) -> DataFrame:
    """Warnings `(subject, message)`: types with fewer than two events, topics with none."""
    few = event_types.where("n_events < 2").select(
        F.concat(F.lit("event type "), "event_type").alias("subject"),
        F.concat(F.lit("not enough events: "), F.col("n_events").cast("string")).alias("message"))
    counted = topics_seen.select("topic", "n_events")
    if topics is not None:
        counted = topics.select("topic").join(counted, "topic", "left")
    none = counted.where(F.coalesce("n_events", F.lit(0)) == 0).select(
        F.concat(F.lit("topic "), "topic").alias("subject"), F.lit("no events received").alias("message"))
    return few.unionByName(none)


def write_reports(reports: dict[str, DataFrame], path: str, format: str = "parquet") -> None:
    """One folder per report."""
    for name, report in reports.items():
        report.write.mode("overwrite").format(format).save(f"{path}/{name}")
