"""Column functions over raw message bytes and decoded events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire format and of the event envelope.
AVRO_MIN_LENGTH = 32
SCHEMA_HASH_LENGTH = 32
MILLISECONDS_MIN_LENGTH = 12
FIELD_ID = "id"
FIELD_TIMESTAMP = "timestamp"
FIELD_EVENT_TYPE = "eventType"
FIELD_VERSION = "version"

# Blank and control characters stripped before looking for the opening brace.
_BLANKS = "".join(chr(c) for c in range(0x21))


def message_text(value: Column) -> Column:
    """Bytes as text; malformed UTF-8 becomes U+FFFD instead of failing the query."""
    return F.make_valid_utf8(value.cast("string"))


def schema_hash_of(value: Column, hash_length: int = SCHEMA_HASH_LENGTH) -> Column:
    return F.make_valid_utf8(F.substring(value, 1, hash_length).cast("string"))


def is_avro_message(value: Column, hash_length: int = SCHEMA_HASH_LENGTH) -> Column:
    """Long enough for a schema hash and not starting like a JSON object."""
    prefix = F.substring(value, 1, hash_length).cast("string")
    return (F.length(value) >= AVRO_MIN_LENGTH) & ~F.startswith(F.ltrim(prefix, F.lit(_BLANKS)), F.lit("{"))


def parse_json(text: Column) -> Column:
    return F.try_parse_json(text)


def field(event: Column, name: str) -> Column:
    """Top-level field as a variant; NULL only when the key is absent, a JSON null is a value."""
    return F.variant_get(event, f"$['{name}']", "variant")


def scalar_text(value: Column) -> Column:
    """Text of a scalar variant: a JSON null reads as `null`, an object or array as the empty text."""
    schema = F.schema_of_variant(value)
    container = schema.startswith("OBJECT<") | schema.startswith("ARRAY<")
    return F.when(F.is_variant_null(value), "null").when(container, "").otherwise(value.try_cast("string"))


def field_text(event: Column, name: str) -> Column:
    return scalar_text(field(event, name))


def timestamp_unit(timestamp_text: Column) -> Column:
    return F.when(timestamp_text.isNull(), F.lit(None).cast("string")).when(
        F.length(timestamp_text) < MILLISECONDS_MIN_LENGTH, "SECONDS"
    ).otherwise("MILLISECONDS")


def event_timestamp(epoch: Column) -> Column:
    """Epoch number in either unit to a timestamp; text that is no number gives NULL."""
    number = epoch.try_cast("bigint")
    return F.when(F.length(epoch.cast("string")) < MILLISECONDS_MIN_LENGTH, F.timestamp_seconds(number)).otherwise(
        F.timestamp_millis(number)
    )


def message_digest(value: Column) -> Column:
    """256-bit digest standing for the bytes of a message in grouping keys."""
    return F.unhex(F.sha2(value, 256))
