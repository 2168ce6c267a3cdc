"""Messages at rest with an index of their offsets.

The files of a message table hold narrow offset ranges of one topic partition each, or of a few small ones. The index
has a row per file and partition: first and last offset, and the number of messages. Partitions without messages are
in it too, if their writer knows of them. A sample then reads only the files that its messages are in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shapelens.session import folder_of, sized
from shapelens.sources.topics import sample_topics

#: Folder of the index inside a message table; readers of the table skip names with an underscore.
INDEX = "_offsets"
PLACE = ["topic", "partition"]


def write_messages(messages: DataFrame, path: str, partitions: DataFrame | None = None) -> None:
    """Write Kafka rows by (topic, partition, offset), and the index beside them. `partitions` is `(topic, partition)` of
    all there are: what the broker lists."""
    messages.repartitionByRange(*PLACE, "offset").sortWithinPartitions(*PLACE, "offset").write.mode("overwrite").parquet(path)
    index = measure_offsets(messages.sparkSession, path)
    if partitions is not None:
        empty = partitions.select(*PLACE).distinct().join(sized(index.select(*PLACE).distinct()), PLACE, "left_anti")
        index = index.unionByName(empty.withColumns({"n": F.lit(0).cast("bigint")}), allowMissingColumns=True)
    index.coalesce(1).write.parquet(f"{path}/{INDEX}")


def measure_offsets(spark: SparkSession, path: str) -> DataFrame:
    """`(topic, partition, first, last, n, file)`; reads the three narrow columns."""
    rows = spark.read.parquet(path).select(*PLACE, "offset", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy(*PLACE, "file").agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count("*").alias("n")).select(*PLACE, "first", "last", "n", "file")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """The index of a message table; measured anew where it was written without one, then without empty partitions."""
    store, folder = folder_of(spark, f"{path}/{INDEX}")
    return spark.read.parquet(f"{path}/{INDEX}") if store.exists(folder) else measure_offsets(spark, path)


def partition_counts(index: DataFrame) -> DataFrame:
    """`(topic, n_partitions, n_empty, n_messages)`: empty partitions count like the others. Reads the index only."""
    parts = index.groupBy(*PLACE).agg(F.sum("n").alias("n"))
    return parts.groupBy("topic").agg(F.count("*").alias("n_partitions"), F.count_if(F.col("n") == 0).alias("n_empty"), F.sum("n").alias("n_messages"))


def files_of_sample(index: DataFrame, n: int, per_partition: bool = False) -> DataFrame:
    """`(topic, partition, file)` of the files that the first `n` messages of each topic can be in.

    In the order of (partition, offset), a file is needed if the files that end before it begins hold fewer than `n`
    messages: of its topic, or with `per_partition` of its partition, as long as the partitions before it gave fewer
    than `n` in all. Works on one row per file and partition.
    """
    held = index.where("n > 0")
    if per_partition:
        taken = held.groupBy(*PLACE).agg(F.least(F.sum("n"), F.lit(n)).alias("taken"))
        before = Window.partitionBy("topic").orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
        reached = taken.withColumn("given", F.coalesce(F.sum("taken").over(before), F.lit(0))).where(F.col("given") < n)
        held = held.join(reached.select(*PLACE), PLACE, "left_semi")
    keys, order = (PLACE, ["first"]) if per_partition else (["topic"], ["partition", "first"])
    # files of one partition may overlap where their writer did not sort: then the later one counts from its first offset
    earlier = Window.partitionBy(*keys).orderBy(*order, "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    overlap = F.coalesce(F.max(F.struct("partition", "last")).over(earlier) >= F.struct("partition", "first"), F.lit(False))
    return held.withColumn("_before", before).withColumn("_overlap", overlap).where((F.col("_before") < n) | F.col("_overlap")).select(*PLACE, "file")


def sample_messages(spark: SparkSession, path: str, n: int, per_partition: bool = False) -> DataFrame:
    """`sample_topics` of a message table, reading the files of the sample only."""
    files = [r.file for r in files_of_sample(offsets(spark, path), n, per_partition).select("file").distinct().orderBy("file").collect()]
    rows = read_messages(spark, path)
    return sample_topics(spark.read.schema(rows.schema).parquet(*files), n, per_partition) if files else rows.where("false")
