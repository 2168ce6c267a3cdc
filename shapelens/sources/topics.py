"""Choosing topics and bounded samples of their messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapelens.session import sized

# Fixed value: topic that is never analysed.
BLACKLIST = ["avro_schema"]


def topic_selected(topic: Column, whitelist: list[str] | None = None) -> Column:
    keep = ~topic.isin(*BLACKLIST) & ~topic.startswith("_")
    return keep & topic.isin(*whitelist) if whitelist else keep


def select_topics(messages: DataFrame, whitelist: list[str] | None = None) -> DataFrame:
    """Distinct topic names to analyse."""
    return messages.select("topic").distinct().where(topic_selected(F.col("topic"), whitelist))


def topic_partition_count(messages: DataFrame) -> DataFrame:
    """Partitions per topic that hold messages (empty ones cannot be seen in the data)."""
    return messages.groupBy("topic").agg(F.count_distinct("partition").alias("n_partitions"))


#: Parts that a key is ranked in first.
PARTS = 64


def first_per_key(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """First `n` rows per key; `order` must be unique within a key.

    Narrow (key, order) tuples are ranked in two rounds: in PARTS parts of each key, dealt by hash, and then among the
    first `n` of each part. So no task ranks more than PARTS times `n` tuples of one key, whatever `n` and the key's
    size are. The full rows are fetched by position, from the range that the chosen ones span.
    """
    narrow = list(dict.fromkeys([*keys, *order]))

    def ranked(picks: DataFrame, by: list[str]) -> DataFrame:
        window = Window.partitionBy(*by).orderBy(*order)
        return picks.withColumn("_n", F.row_number().over(window)).where(F.col("_n") <= n).drop("_n")

    parts = rows.select(*narrow).withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(PARTS)))
    picks = sized(ranked(ranked(parts, [*keys, "_part"]).drop("_part"), keys))
    span = picks.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in order for f in (F.min, F.max)]).first()
    for c in order:
        if span[f"{c}_min"] is not None:
            rows = rows.where(F.col(c).between(F.lit(span[f"{c}_min"]), F.lit(span[f"{c}_max"])))
    return rows.join(picks, narrow, "left_semi")


def sample_topics(messages: DataFrame, n: int, per_partition: bool = False) -> DataFrame:
    """First `n` messages per topic by (partition, offset).

    `per_partition` takes up to `n` from each partition in turn and stops once the running total reaches `n`,
    so it may overshoot.
    """
    if not per_partition:
        return first_per_key(messages, ["topic"], ["partition", "offset"], n)
    # Partitions are few, so the running total works on one row each.
    taken = messages.groupBy("topic", "partition").agg(F.least(F.count("*"), F.lit(n)).alias("_taken"))
    earlier = Window.partitionBy("topic").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    open_parts = sized(
        taken.withColumn("_before", F.coalesce(F.sum("_taken").over(earlier), F.lit(0)))
        .where(F.col("_before") < n).select("topic", "partition")
    )
    return first_per_key(messages.join(open_parts, ["topic", "partition"], "left_semi"), ["topic", "partition"], ["offset"], n)


def read_kafka(spark: SparkSession, servers: str, topics: str, pattern: bool = True, starting: str = "earliest",
               ending: str = "latest") -> DataFrame:
    """Bounded batch read of Kafka topics in the row layout used here (needs the Kafka connector package).

    `starting` and `ending` are offset specifications of the connector: a word, or JSON with an offset per partition,
    by which a sample or an increment reads no more than its own range.
    """
    return (
        spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribePattern" if pattern else "subscribe", topics)
        .option("startingOffsets", starting).option("endingOffsets", ending).load()
        .select("topic", "partition", "offset", "value")
    )
