"""Raw messages to decoded, classified events."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelens.functions import messages as m
from shapelens.operators.copies import in_shared_cell
from shapelens.session import sized
from shapelens.sources.registry import schema_registry_lookup

MESSAGE_COLUMNS = ["topic", "partition", "offset", "value"]

# Reasons a message is set aside.
NULL_MESSAGE = "null message"
UNKNOWN_SCHEMA = "unknown schema"
UNPARSABLE = "unparsable message"
NO_EVENT_TYPE = "no eventType"
NO_TIMESTAMP = "no timestamp"


class AvroUnavailable(RuntimeError):
    """Avro bodies were asked for in a session without the spark-avro package."""


def decode_messages(messages: DataFrame, registry: DataFrame | None = None,
                    hash_length: int = m.SCHEMA_HASH_LENGTH) -> DataFrame:
    """Add `is_avro, schema_hash, event, event_text, broken_reason` to Kafka rows.

    JSON bodies become a VARIANT in `event`, and stay as text in `event_text`. Avro bodies stay bytes here (see `decode_avro`); with a `registry` only
    those with an unknown hash are broken, without one all are.
    """
    value = F.col("value")
    rows = messages.select(
        *messages.columns,
        m.is_avro_message(value, hash_length).alias("is_avro"),
        m.message_text(value).alias("text"),
    )
    # Decoding comes out of a one-row generator: filters on its results stay above it, so that Catalyst does not
    # copy the JSON parse into them.
    rows = rows.select(*messages.columns, F.inline_outer(F.array(F.struct(
        "is_avro",
        F.when(F.col("is_avro"), m.schema_hash_of(value, hash_length)).alias("schema_hash"),
        F.when(~F.col("is_avro"), m.parse_json(F.col("text"))).alias("event"),
        F.when(~F.col("is_avro"), F.col("text")).alias("event_text"),
    ))))
    known = F.lit(False)
    if registry is not None:
        carried = messages.select(F.when(m.is_avro_message(value, hash_length), m.schema_hash_of(value, hash_length)).alias("schema_hash"), F.octet_length("value").alias("n_bytes"))
        rows = schema_registry_lookup(rows, registry, carried)
        known = F.col("schema_json").isNotNull()
    reason = (
        F.when(value.isNull(), NULL_MESSAGE)
        .when(F.col("is_avro"), F.when(~known, UNKNOWN_SCHEMA))
        .when(F.col("event").isNull(), UNPARSABLE)
    )
    return rows.withColumn("broken_reason", reason)


def avro_available(spark: SparkSession) -> bool:
    """Whether the session has the spark-avro package."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Py4JJavaError:
        return False
    return True


def used_schemas(decoded: DataFrame) -> dict[str, str]:
    """Schema text by hash, of the registered hashes that messages carry: what a driver can hold, whatever the registry holds."""
    found = decoded.where("is_avro and schema_json is not null").groupBy("schema_hash").agg(F.first("schema_json").alias("schema_json"))
    return {r.schema_hash: r.schema_json for r in found.collect()}


def decode_avro(decoded: DataFrame, schemas: dict[str, str] | None = None, hash_length: int = m.SCHEMA_HASH_LENGTH,
                decoder: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Fill `event` of known Avro rows; what cannot be decoded becomes broken.

    Bodies are Avro's binary encoding, read by Spark's own `from_avro` with the schemas in use (`used_schemas`, unless
    given). A `decoder(body, schema_hash)` giving JSON text stands in for other encodings, such as Avro's JSON one.
    """
    spark = decoded.sparkSession
    body = F.expr(f"substring(value, {hash_length + 1})")
    if decoder is not None:
        text = decoder(body, F.col("schema_hash"))
    else:
        if not avro_available(spark):
            raise AvroUnavailable("decoding Avro bodies needs the spark-avro package in this session")
        from pyspark.sql.avro.functions import from_avro

        schemas = used_schemas(decoded) if schemas is None else schemas
        decoders = [F.when(F.col("schema_hash") == h, F.to_json(from_avro(body, s, {"mode": "PERMISSIVE"}))) for h, s in sorted(schemas.items())]
        text = F.coalesce(*decoders) if decoders else F.lit(None).cast("string")
    known = F.col("is_avro") & F.col("broken_reason").isNull()
    columns = [c for c in decoded.columns if c not in ("event", "event_text", "broken_reason")]
    # A one-row generator, as in `decode_messages`: the body is decoded and parsed once.
    rows = decoded.withColumn("_text", F.when(known, text)).select(*columns, "broken_reason", F.inline_outer(F.array(F.struct(
        F.coalesce("event", m.parse_json(F.col("_text"))).alias("event"), F.coalesce("event_text", "_text").alias("event_text")))))
    reason = F.coalesce("broken_reason", F.when(F.col("is_avro") & F.col("event").isNull(), UNPARSABLE))
    return rows.withColumn("broken_reason", reason).select(*decoded.columns)


def classify_events(decoded: DataFrame) -> DataFrame:
    """Add the envelope and `invalid_reason`; the event type is checked first, then the timestamp.

    A broken message has neither, nor has a known Avro message whose body nobody has decoded: it is neither broken nor
    invalid, and `undecoded` says so. `event_type` is set for valid events only, so it serves as the grouping key of
    everything behind without a filter that would parse the JSON a second time.
    """
    columns = decoded.columns
    fields = {"id": m.FIELD_ID, "timestamp_text": m.FIELD_TIMESTAMP, "type_text": m.FIELD_EVENT_TYPE, "version": m.FIELD_VERSION}
    rows = decoded.select(*columns, *[m.field(F.col("event"), f).alias(c) for c, f in fields.items()])
    undecoded = F.col("is_avro") & F.col("broken_reason").isNull() & F.col("event").isNull()
    readable = F.col("broken_reason").isNull() & ~undecoded
    has_type, has_time = F.col("type_text").isNotNull(), F.col("timestamp_text").isNotNull()
    return rows.select(
        *columns, m.scalar_text(F.col("id")).alias("id"), m.scalar_text(F.col("timestamp_text")).alias("timestamp_text"),
        m.scalar_text(F.col("version")).alias("version"), F.coalesce(undecoded, F.lit(False)).alias("undecoded"),
        F.when(readable & ~has_type, NO_EVENT_TYPE).when(readable & ~has_time, NO_TIMESTAMP).alias("invalid_reason"),
        F.when(readable & has_type & has_time, m.scalar_text(F.col("type_text"))).alias("event_type"),
    ).withColumn("timestamp_unit", m.timestamp_unit(F.col("timestamp_text")))


def split_broken(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(not broken, broken); broken messages keep every copy."""
    return decoded.where("broken_reason is null"), decoded.where("broken_reason is not null")


def split_invalid(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) among the readable events."""
    return classified.where("event_type is not null"), classified.where("invalid_reason is not null")


def position(partition="partition", offset="offset"):
    """Partition and offset as one sortable value."""
    return F.struct(F.col(partition).cast("int").alias("partition"), F.col(offset).cast("bigint").alias("offset"))


def distinct_positions(events: DataFrame, by: list[str] | None = None) -> DataFrame:
    """`(by, topic, partition, offset, n_copies)` of the first copy of byte-equal messages within `by` (default: per topic).

    Only messages that may have copies are shuffled, as digests and positions (see `copies`), and groups of copies,
    however large, shrink to one row map-side. Null messages have no bytes to compare and each stand for themselves.
    """
    by = by or ["topic"]
    kept = [c for c in by if c != "topic"]
    # topic breaks ties when a group spans topics
    place = F.struct(F.col("topic"), position().alias("position"))
    marked = in_shared_cell(events.select(*dict.fromkeys([*by, "topic", "partition", "offset", "value"])), by)
    alone = marked.where("not _shared").select(*kept, "topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"), F.lit(1).cast("bigint").alias("n_copies"))
    groups = marked.where("_shared").select(*by, m.message_digest(F.col("value")).alias("_digest"), place.alias("_place")).groupBy(*by, "_digest").agg(
        F.min("_place").alias("_first"), F.count("*").alias("n_copies"))
    return alone.unionByName(groups.select(*kept, F.col("_first.topic").alias("topic"), "_first.position.partition", "_first.position.offset", "n_copies"))


def distinct_events(events: DataFrame, by: list[str] | None = None, digest: str | None = None) -> DataFrame:
    """The first copies with all their columns. Where positions are enough, take `distinct_positions`: this one has to
    bring whole rows together with the groups that have copies, once these are more than a broadcast holds. `digest` names
    a column that has the messages' digests already."""
    by = by or ["topic"]
    keyed = events.withColumn("_digest", m.message_digest(F.col("value")) if digest is None else F.col(digest)).withColumn("_place", F.struct(F.col("topic"), position().alias("position")))
    groups = keyed.groupBy(*by, "_digest").agg(F.count("*").alias("_copies"), F.min("_place").alias("_first"))
    repeated = sized(groups.where("_copies > 1").drop("_copies"))
    joined = keyed.join(repeated, [*by, "_digest"], "left")
    return joined.where(F.col("_first").isNull() | (F.col("_place") == F.col("_first"))).select(*events.columns)
