"""Schema registry and structure registry tables."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapelens.session import fits_broadcast, sized
from shapelens.sources.snapshots import Snapshot, current, write_snapshot


#: Error conditions of Spark for a folder without data.
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def registry_from_base64(table: DataFrame) -> DataFrame:
    """Key-value export `(key, value)` with base64 schema text to `(schema_hash, schema_json)`."""
    return table.select(
        F.element_at(F.split("key", "/"), -1).alias("schema_hash"),
        F.unbase64("value").cast("string").alias("schema_json"),
    )


#: A hash that at least this share of the messages carries is hot; so there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.005
#: Most text of hot schemas that is broadcast, the most frequent first; the rest is joined like others.
HOT_CHARS = 16_000_000
#: Text of schemas and messages that one task of the lookup sorts; compressed shuffle files say little about it.
TASK_BYTES = 32 << 20
#: Bytes taken for a message where nothing says how long it is.
MESSAGE_BYTES = 200


def hot_schemas(hashes: DataFrame, schemas: DataFrame, share: float = HOT_SHARE, chars: int = HOT_CHARS) -> DataFrame:
    """`(_hash, hot_json)` of the hot hashes in `(schema_hash)`, with null where no schema has such a hash.

    The counts shrink map-side; what is left has at most 1 / share rows and `chars` characters of text.
    """
    counts = sized(hashes.where("schema_hash is not null").groupBy(F.col("schema_hash").alias("_hash")).agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") >= max(1.0, total * share))
    found = hot.join(schemas.join(F.broadcast(hot.select("_hash")), "_hash", "left_semi"), "_hash", "left")
    before = Window.orderBy(F.col("n").desc(), "_hash").rowsBetween(Window.unboundedPreceding, 0)
    return sized(found.withColumn("_chars", F.sum(F.coalesce(F.length("schema_json"), F.lit(0))).over(before)).where(F.col("_chars") <= chars).select(
        "_hash", F.col("schema_json").alias("hot_json")))


def text_bytes(registry: DataFrame) -> int:
    """Bytes of all schema texts: Catalyst takes a text that is made on the way for 20 bytes."""
    return registry.agg(F.sum(F.octet_length("schema_json"))).first()[0] or 0


def lookup_tasks(hashes: DataFrame, schema_bytes: int) -> int:
    """Tasks among which the texts of a registry and of messages are dealt, so that what one of them holds does not grow.

    `hashes` may have the messages' lengths as `n_bytes`.
    """
    length = F.coalesce(F.sum("n_bytes"), F.lit(0)) if "n_bytes" in hashes.columns else F.count("*") * MESSAGE_BYTES
    n_bytes = schema_bytes + hashes.agg(length).first()[0]
    return max(int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / TASK_BYTES))


def schema_registry_lookup(messages: DataFrame, registry: DataFrame, hashes: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """Left join `schema_json` by `schema_hash`.

    A registry that Catalyst broadcasts, and whose texts are no more than those of hot schemas may be, is joined at once. Beyond that size the join shuffles: schemas of hot hashes are
    found by counting and broadcast, and rows that have theirs, or no hash at all, get spread keys instead of meeting in
    one task. `hashes` is where the counting reads `schema_hash` (the messages themselves, unless something cheaper
    holds it); `small` overrides the look at the registry's size. Tasks are as many as the texts need (`lookup_tasks`).
    """
    schemas = registry.groupBy(F.col("schema_hash").alias("_hash")).agg(F.min("schema_json").alias("schema_json"))
    schema_bytes = text_bytes(registry)
    if small is None:
        small = schema_bytes <= HOT_CHARS and fits_broadcast(registry)
    if small:
        return messages.join(schemas.withColumnRenamed("_hash", "schema_hash"), "schema_hash", "left").select(*messages.columns, "schema_json")
    hashes = messages.select("schema_hash") if hashes is None else hashes
    tasks = lookup_tasks(hashes, schema_bytes)
    hot = hot_schemas(hashes, schemas)
    first = messages.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), F.col("schema_hash") == F.col("_hash"), "left").drop("_hash")
    spread = F.concat(F.lit("{"), F.xxhash64("topic", "partition", "offset").cast("string"))
    keyed = first.withColumn("_hash", F.when(F.col("_hot") | F.col("schema_hash").isNull(), spread).otherwise(F.col("schema_hash")))
    # dealt before they are grouped: texts are sorted once, for both the minimum and the join
    dealt = registry.select(F.col("schema_hash").alias("_hash"), "schema_json").repartition(tasks, "_hash").groupBy("_hash").agg(F.min("schema_json").alias("schema_json"))
    return keyed.repartition(tasks, "_hash").join(dealt.hint("merge"), "_hash", "left").withColumn("schema_json", F.coalesce("hot_json", "schema_json")).select(*messages.columns, "schema_json")


def schema_conflicts(registry: DataFrame) -> DataFrame:
    """Hashes registered with more than one schema text."""
    distinct = registry.groupBy("schema_hash", F.sha2("schema_json", 256).alias("text")).agg(F.lit(1).alias("one"))
    return distinct.groupBy("schema_hash").agg(F.count("*").alias("n_schemas")).where("n_schemas > 1")


def write_structure_registry(structure: DataFrame, path: str, run: str, after: int | None = None) -> Snapshot:
    """Save the merged structures of one run as a snapshot (see `snapshots.write_snapshot`)."""
    return write_snapshot(structure, path, run, after)


def read_structure_registry(spark: SparkSession, path: str, run: str | None = None) -> DataFrame | None:
    """Structures of the latest snapshot, or of the latest one of `run`; None if there is none."""
    snapshot = current(spark, path, run)
    return snapshot.read(spark) if snapshot else None


def write_samples(events: DataFrame, path: str, k: int = 10) -> None:
    """First `k` distinct events per type as JSON lines; types that already have `k` are skipped."""
    from shapelens.sources.topics import first_per_key

    spark = events.sparkSession
    try:
        have = spark.read.text(path).groupBy("event_type").count().where(F.col("count") >= k).select("event_type")
        events = events.join(sized(have), "event_type", "left_anti")
    except AnalysisException as error:
        if error.getCondition() not in NOTHING_THERE:
            raise
    picked = first_per_key(events, ["event_type"], ["topic", "partition", "offset"], k)
    picked = sized(picked.select("event_type", F.to_json("event").alias("value")))
    (picked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_type").text(path))
