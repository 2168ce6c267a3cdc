"""Keeping the merged structure of a message stream."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shapelens.operators.decode import classify_events, decode_messages
from shapelens.operators.open_keys import open_of
from shapelens.operators.paths import event_of_shape_sql, json_paths, paths_of_shapes, shape_sql
from shapelens.operators.structure import from_registry, merge_structures
from shapelens.session import intermediates, sized
from shapelens.sources.registry import read_structure_registry, write_structure_registry
from shapelens.sources.snapshots import expire, last_number, snapshots


def latest_structures(spark, path: str) -> DataFrame | None:
    """The structures of the latest snapshot of any query; None before the first."""
    return read_structure_registry(spark, path)


def merge_batch(messages: DataFrame, batch_id: int, path: str, query: str, sticky: bool = False, keep: int = 3) -> None:
    """Merge one micro-batch into the registry.

    A snapshot is named by its query and batch. A batch that is run again finds its own snapshot and adds nothing, so
    counts are added once; a query with a new checkpoint goes on from the latest snapshot of the queries before it, and
    another query that writes at the same time is a conflict. The last `keep` snapshots stay.
    """
    spark = messages.sparkSession
    name = f"{query}-{batch_id}"
    with intermediates(spark):
        found = snapshots(spark, path)
        if any(s.run == name for s in found):
            return
        after = last_number(spark, path)
        before = found[-1].read(spark) if found else None
        paths = json_paths(classify_events(decode_messages(messages)), known=None if before is None else open_of(before))
        sources = [paths] if before is None else [paths, from_registry(before)]
        write_structure_registry(merge_structures(*sources, sticky=sticky), path, name, after)
        expire(spark, path, keep)


def stream_structures(messages: DataFrame, path: str, checkpoint: str, sticky: bool = False, **trigger) -> StreamingQuery:
    """Start a query that keeps the structure registry at `path` up to date with a stream of Kafka rows.

    The checkpoint is what makes batches of one query, also over restarts.
    """
    query = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: merge_batch(batch, batch_id, path, query, sticky))
    return (writer.trigger(**trigger) if trigger else writer).start()


def shape_counts(messages: DataFrame) -> DataFrame:
    """`(event_type, shape, n)` of a stream or table of Kafka rows; null types are left in.

    The shape of an event is made row by row, so that on a stream the count is the only state: one row per shape.
    """
    events = classify_events(decode_messages(messages))
    return events.selectExpr("event_type", f"if(event_type is null, null, {shape_sql('event_text')}) as shape").groupBy("event_type", "shape").agg(F.count("*").alias("n"))


def publish_shapes(counts: DataFrame, batch_id: int, path: str, query: str, sticky: bool = False, keep: int = 3) -> None:
    """Write the structures of all shapes counted so far as a snapshot. Nothing is read but which snapshots there are;
    a batch that has published already does nothing."""
    spark = counts.sparkSession
    name = f"{query}-{batch_id}"
    with intermediates(spark):
        if any(s.run == name for s in snapshots(spark, path)):
            return
        after = last_number(spark, path)
        shapes = sized(counts.where("event_type is not null")).selectExpr("event_type", f"parse_json({event_of_shape_sql('shape')}) as event", "n")
        write_structure_registry(merge_structures(paths_of_shapes(shapes), sticky=sticky), path, name, after)
        expire(spark, path, keep)


def stream_shapes(messages: DataFrame, path: str, checkpoint: str, sticky: bool = False, **trigger) -> StreamingQuery:
    """Like `stream_structures`, with the counts kept by Spark as state instead of in the registry.

    State and offsets are checkpointed together, so every message counts once over restarts, and no batch reads what
    earlier ones wrote. The registry then belongs to this query: a new checkpoint begins at zero. Take
    `stream_structures` where several queries, or batch runs, add to one registry.
    """
    query = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    writer = shape_counts(messages).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: publish_shapes(batch, batch_id, path, query, sticky))
    return (writer.trigger(**trigger) if trigger else writer).start()
