"""Merged structures: one row per event type and path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapelens.functions import types as t
from shapelens.functions.json_types import has_type, types_in
from shapelens.functions.naming import last_name, parent_path, path_depth
from shapelens.operators.open_keys import FIELD_SHARE, OPEN_FROM, has_wild, is_wild, opened, with_wild
from shapelens.session import sized

AVRO_SETS = ["avro_types", "avro_union_types", "avro_enum_symbols", "avro_item_types", "avro_item_names",
             "avro_map_value_types"]
SAVED = ["saved_primitive", "saved_item_primitive"]
COMMON = ["event_type", "path", "mask", "n_trees", "optional", *AVRO_SETS, *SAVED]


def _common(source: DataFrame) -> DataFrame:
    have = set(source.columns)
    empty = F.array().cast("array<string>")
    filled = {
        **{c: F.col(c) for c in ("event_type", "path", "mask", "n_trees", "optional")},
        **{c: F.col(c) if c in have else empty for c in AVRO_SETS},
        **{c: F.col(c) if c in have else F.lit(None).cast("string") for c in SAVED},
    }
    return source.select(*[filled[c].alias(c) for c in COMMON])


def from_registry(previous: DataFrame) -> DataFrame:
    """Last run's merged structure as a merge input; its resolved types become the saved ones."""
    return previous.withColumn("saved_primitive", F.col("primitive")).withColumn(
        "saved_item_primitive", F.col("item_primitive"))


def _by_path(union: DataFrame) -> DataFrame:
    return sized(union.groupBy("event_type", "path").agg(
        *[F.expr(e) for e in ("bit_or(mask) as mask", "sum(n_trees) as n_trees", "bool_or(optional) as optional")],
        *[F.expr(f"array_sort(array_distinct(flatten(collect_set({c})))) as {c}") for c in AVRO_SETS],
        *[F.expr(f"max({c}) as {c}") for c in SAVED],
    ).withColumn("parent_path", parent_path(F.col("path"))))


def merge_structures(*sources: DataFrame, sticky: bool = False, open_from: int | None = OPEN_FROM, field_share: float = FIELD_SHARE) -> DataFrame:
    """Union of paths and type sets over event, Avro and earlier structures.

    A path is optional when a source says so or when fewer trees have it than have its parent. The inputs are
    counts per path, so the result does not depend on their order, and merging in parts gives the same.

    An object that only the sources together show to be open (see `open_keys`) is opened here. An event then counts once
    for each of its keys, so the count below it is no more than a bound: at most that of the object.
    """
    union = _common(sources[0])
    for source in sources[1:]:
        union = union.unionByName(_common(source))
    # small, and read several times below
    merged, known = _by_path(union), None
    while open_from is not None:
        more = opened(merged, known, limit=open_from, share=field_share)
        if more is None:
            break
        known = more
        merged = _by_path(with_wild(union, known))
    parents = merged.selectExpr("event_type", "path as parent_path", "n_trees as parent_trees")
    inner = merged.where("parent_path is not null").select("event_type", F.col("parent_path").alias("path"), F.col("path").alias("child")).groupBy(
        "event_type", "path").agg(F.count("*").alias("n_children"), F.expr(f"bool_or({is_wild('child')}) as is_map"))
    joined = merged.join(parents, ["event_type", "parent_path"], "left").join(inner, ["event_type", "path"], "left")
    joined = joined.withColumn("n_trees", F.when(F.expr(has_wild("path")), F.least("n_trees", "parent_trees")).otherwise(F.col("n_trees")))
    optional = F.expr("coalesce(optional, false) or coalesce(n_trees < parent_trees, false)")
    return describe(joined.withColumn("optional", optional), sticky)


def describe(rows: DataFrame, sticky: bool) -> DataFrame:
    """Names and resolved types of merged rows."""
    primitive = t.resolve_primitive("mask", "avro_types", "avro_union_types")
    item = t.resolve_item_primitive("mask", "avro_item_types")
    if sticky:
        primitive, item = f"coalesce(saved_primitive, {primitive})", f"coalesce(saved_item_primitive, {item})"
    # an open object is a leaf like any other value, and its keys' values are none: no column could hold them one by one
    rows = rows.withColumn("is_map", F.expr("coalesce(is_map, false) and path <> ''")).withColumns({
        "is_leaf": F.expr(f"(n_children is null or is_map) and path <> '' and not {has_wild('path')}"),
        "is_array": F.expr(f"""{has_type("mask", "ARRAY")} or array_contains(avro_types, 'ARRAY')
                               or array_contains(avro_union_types, 'ARRAY')"""),
    })
    return rows.select(
        "event_type", "path", "parent_path", last_name(F.col("path")).alias("name"), path_depth(F.col("path")).alias("depth"),
        "optional", "n_trees", "mask", types_in("mask").alias("json_types"), types_in("mask", item=True).alias("item_types"),
        *AVRO_SETS, "is_leaf", "is_array", "is_map", F.expr(f"case when is_map then 'TEXT' when n_children is null and path <> '' then {primitive} end as primitive"),
        F.expr(f"if(n_children is null and path <> '' and is_array, {item}, null) as item_primitive"),
    )


def structure_lineage(structures: DataFrame) -> DataFrame:
    """Structures that fed each merged one, one row each: distinct `(event_type, structure_id, source)`.
    The last run's own tree is left out, so that an unchanged run gives an unchanged result."""
    return structures.where(F.col("source") != "DESERIALIZED").select("event_type", "structure_id", "source").distinct()
