"""Reports per schema and per structure, and which structures fed a merged one over all runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapelens.operators.avro import avro_paths
from shapelens.session import sized

EVENT, AVRO, MERGED, EARLIER = "EVENT", "AVRO", "MERGE", "DESERIALIZED"
EDGES = "run bigint, event_type string, structure_id string, source string, merged_id string"
_AVRO_COLUMNS = ["avro_types", "avro_union_types", "avro_enum_symbols", "avro_item_types", "avro_item_names", "avro_map_value_types"]


def schema_trees(paths: DataFrame) -> DataFrame:
    """`(schema_hash, structure_id, n_nodes)` of `avro_paths`: an id for each tree, whatever schema it comes from."""
    node = F.struct("path", "optional", *_AVRO_COLUMNS)
    return paths.groupBy("schema_hash").agg(F.sha2(F.to_json(F.array_sort(F.collect_list(node))), 256).alias("structure_id"), F.count("*").alias("n_nodes"))


def merged_trees(structure: DataFrame) -> DataFrame:
    """`(event_type, structure_id, n_nodes)` of merged structures; counts are no part of the id, optional flags are."""
    node = F.struct("path", "optional", "json_types", "item_types", *_AVRO_COLUMNS)
    return structure.groupBy("event_type").agg(F.sha2(F.to_json(F.array_sort(F.collect_list(node))), 256).alias("structure_id"), F.count("*").alias("n_nodes"))


def carried_schemas(classified: DataFrame) -> DataFrame:
    """`(schema_hash, event_type, version, n_messages)`: which messages carry a schema; the type is null where none was read."""
    return classified.where("is_avro and broken_reason is null").groupBy("schema_hash", "event_type", "version").agg(F.count("*").alias("n_messages"))


def schema_report(registry: DataFrame, classified: DataFrame) -> DataFrame:
    """Per schema that messages carry: name, full name, versions and event types of its messages, their number, its tree."""
    carried = sized(carried_schemas(classified))
    texts = registry.join(carried.select("schema_hash").distinct(), "schema_hash", "left_semi").groupBy("schema_hash").agg(F.min("schema_json").alias("schema_json"))
    texts = sized(texts)
    trees = schema_trees(avro_paths(texts))
    schema = F.try_parse_json("schema_json")
    name, space = F.try_variant_get(schema, "$.name", "string"), F.try_variant_get(schema, "$.namespace", "string")
    full = F.when(F.contains(name, F.lit(".")) | space.isNull() | (space == ""), name).otherwise(F.concat(space, F.lit("."), name))
    use = carried.groupBy("schema_hash").agg(
        F.sum("n_messages").alias("n_messages"), F.array_sort(F.collect_set("event_type")).alias("event_types"), F.array_sort(F.collect_set("version")).alias("versions"))
    return use.join(texts, "schema_hash").join(trees, "schema_hash").select(
        "schema_hash", F.regexp_extract(name, r"[^.]+$", 0).alias("name"), full.alias("full_name"), "versions", "event_types", "n_messages", "structure_id", "n_nodes", "schema_json")


def structure_report(trees: DataFrame, structure: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """`(event_type, structure_id, source, n_events, n_nodes)` of all structures of a run: those of events
    (`event_structures`), of the schemas that they carry (`schema_report`), and the merged ones."""
    n_nodes = F.size(F.array_distinct(F.transform("nodes", lambda n: n.path))).cast("bigint")
    rows = trees.select("event_type", "structure_id", F.lit(EVENT).alias("source"), "n_events", n_nodes.alias("n_nodes"))
    if schemas is not None:
        of_schemas = schemas.select(F.explode("event_types").alias("event_type"), "structure_id", F.lit(AVRO).alias("source"), "n_messages", "n_nodes")
        rows = rows.unionByName(of_schemas.groupBy("event_type", "structure_id", "source", "n_nodes").agg(F.sum("n_messages").alias("n_events")))
    root = structure.where("path = ''").select("event_type", F.col("n_trees").alias("n_events"))
    merged = merged_trees(structure).join(root, "event_type").select("event_type", "structure_id", F.lit(MERGED).alias("source"), "n_events", "n_nodes")
    return rows.unionByName(merged)


def lineage_edges(report: DataFrame, run: int, previous: DataFrame | None = None) -> DataFrame:
    """One run's edges from each structure of a `structure_report` to the merged one of its type: the columns of `EDGES`.

    The merged structure of the run before is a source too, under its own name, so that runs hang together.
    """
    merged = report.where(F.col("source") == MERGED).select("event_type", F.col("structure_id").alias("merged_id"))
    sources = report.where(F.col("source") != MERGED).select("event_type", "structure_id", "source")
    if previous is not None:
        sources = sources.unionByName(merged_trees(previous).select("event_type", "structure_id", F.lit(EARLIER).alias("source")))
    return sources.join(merged, "event_type").select(F.lit(run).cast("bigint").alias("run"), "event_type", "structure_id", "source", "merged_id")


def lineage(edges: DataFrame) -> DataFrame:
    """`(event_type, merged_id, structure_id, source, run)`: every structure of events and schemas that fed a merged one,
    in its own run or through the merged structures of earlier ones, with the first run that had it.

    `edges` are those of all runs. A run that changed nothing points at itself and is passed over; runs only point back,
    so the recursion ends after as many steps as a type has had different merged structures.
    """
    spark = edges.sparkSession
    steps = edges.groupBy("event_type", "structure_id", "source", "merged_id").agg(F.min("run").alias("run"))
    return spark.sql("""
        WITH RECURSIVE up(event_type, merged_id, via, run) MAX RECURSION LEVEL 100000 AS (
          SELECT event_type, merged_id, merged_id, max(run) FROM {steps} GROUP BY event_type, merged_id
          UNION ALL
          SELECT u.event_type, u.merged_id, e.structure_id, e.run FROM up u JOIN {steps} e
          ON e.event_type = u.event_type AND e.merged_id = u.via AND e.run <= u.run AND e.source = {earlier} AND e.structure_id <> e.merged_id)
        SELECT u.event_type, u.merged_id, e.structure_id, e.source, min(e.run) AS run
        FROM up u JOIN {steps} e ON e.event_type = u.event_type AND e.merged_id = u.via WHERE e.source <> {earlier}
        GROUP BY u.event_type, u.merged_id, e.structure_id, e.source""", steps=sized(steps), earlier=EARLIER)
