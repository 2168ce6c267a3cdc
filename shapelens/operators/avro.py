"""Avro schemas to structure paths: a job over the registry table, one row per schema."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelens.functions.naming import child_path
from shapelens.session import sized, sized_with

# Avro type names that need no definition, and those that introduce a name.
PRIMITIVES = ["null", "boolean", "int", "long", "float", "double", "bytes", "string"]
NAMED = ["record", "enum", "fixed"]

_OBJECT = "map<string,variant>"
_ARRAY = "array<variant>"
_VARIANT = "variant"


def _text(schema: Column, field: str) -> Column:
    return F.try_variant_get(schema, f"$.{field}", "string")


def _part(schema: Column, field: str) -> Column:
    return F.variant_get(schema, f"$.{field}", _VARIANT)


def _is(schema: Column, shape: str) -> Column:
    return F.schema_of_variant(schema).startswith(shape)


def _type_name(schema: Column) -> Column:
    """`union`, a primitive, a complex type, or the name of a type defined elsewhere in the schema."""
    return (
        F.when(_is(schema, "ARRAY<"), "union").when(_is(schema, "STRING"), schema.try_cast("string"))
        .otherwise(_text(schema, "type"))
    )


def _namespace(schema: Column, enclosing: Column) -> Column:
    name = _text(schema, "name")
    dotted = F.when(name.contains("."), F.regexp_replace(name, r"\.[^.]*$", ""))
    return F.coalesce(dotted, F.when(_is(schema, "OBJECT<"), _text(schema, "namespace")), enclosing)


def _full_name(name: Column, namespace: Column) -> Column:
    return F.when(name.contains(".") | (namespace == ""), name).otherwise(F.concat(namespace, F.lit("."), name))


#: Levels of nesting that one pass over the open schemas looks into.
LEVELS = 3


def _inner(schema: Column) -> Column:
    """The schemas right below a schema: types of fields, items, map values, branches, and a type in a wrapper."""
    none = F.array().cast(_ARRAY)
    fields = F.transform(F.try_variant_get(schema, "$.fields", _ARRAY), lambda f: _part(f, "type"))
    parts = F.array(_part(schema, "items"), _part(schema, "values"), _part(schema, "type"))
    below = F.when(_is(schema, "ARRAY<"), schema.try_cast(_ARRAY)).otherwise(F.concat(F.coalesce(fields, none), parts))
    return F.filter(below, lambda s: _is(s, "OBJECT<") | _is(s, "ARRAY<"))


def _definitions(schemas: DataFrame) -> DataFrame:
    """All named types of all schemas: `(schema_hash, full_name, definition, namespace)`."""
    rows, found = schemas.withColumn("open", F.lit(True)), []
    space = _namespace(F.col("schema"), F.col("namespace"))
    itself = F.array(F.struct(F.col("schema").alias("schema"), F.col("namespace").alias("namespace"), F.lit(False).alias("open")))
    below = F.transform(_inner(F.col("schema")), lambda s: F.struct(s.alias("schema"), space.alias("namespace"), F.lit(True).alias("open")))
    step = F.inline(F.when(F.col("open"), F.concat(itself, below)).otherwise(itself))
    while True:  # ends: a text is nested finitely
        for _ in range(LEVELS):
            rows = rows.select("schema_hash", step)
        rows, left = sized_with(rows, F.sum(F.col("open").cast("int")))
        found.append(rows.where("not open"))
        if not left:
            break
        rows = rows.where("open")
    named = reduce(DataFrame.unionByName, found).where(_is(F.col("schema"), "OBJECT<") & _text(F.col("schema"), "type").isin(*NAMED))
    named = named.withColumn("namespace", _namespace(F.col("schema"), F.col("namespace")))
    return sized(named.select(
        "schema_hash", _full_name(_text(F.col("schema"), "name"), F.col("namespace")).alias("full_name"),
        F.col("schema").alias("definition"), F.col("namespace").alias("defined_in")))


#: Stands for the name of a schema's own record.
_OWN_NAME = "-"


def _nameless(registry: DataFrame) -> DataFrame:
    """`(schema_hash, tree)`: digest and text of each schema without the name of its own record.

    The name of the outermost record is no part of any path, unless the schema uses it elsewhere or takes a namespace
    from it; schemas that differ in nothing else have one tree of paths.
    """
    name = F.try_variant_get(F.try_parse_json("schema_json"), "$.name", "string")
    text, quoted = F.col("schema_json"), F.concat(F.lit('"'), name, F.lit('"'))
    others = F.replace(text, quoted, F.lit(f'"{_OWN_NAME}"'))
    once = (F.length(text) - F.length(F.replace(text, name, F.lit(""))) == F.length(name)) & (others != text) & ~F.contains(name, F.lit(".")) & (name != "")
    return registry.select("schema_hash", F.when(once, others).otherwise(text).alias("tree_json")).select("schema_hash", F.sha2("tree_json", 256).alias("tree"), "tree_json")


def avro_paths(registry: DataFrame) -> DataFrame:
    """Paths of every schema in `(schema_hash, schema_json)`: the columns of `tree_paths`.

    Schemas that are alike but for the name of their own record are walked once, so the work behind the first pass over
    the registry follows the number of different trees. A hash with several texts has the paths of all of them.
    """
    named = sized(_nameless(registry))
    trees = sized(named.groupBy("tree").agg(F.min("tree_json").alias("schema_json")))
    paths = sized(tree_paths(trees.withColumnRenamed("tree", "schema_hash")))
    spread = named.select("schema_hash", "tree").distinct().join(paths.withColumnRenamed("schema_hash", "tree"), "tree").drop("tree")
    several = named.groupBy("schema_hash").agg(F.count_distinct("tree").alias("n")).where("n > 1")
    if several.isEmpty():
        return spread.select("schema_hash", *[c for c in paths.columns if c != "schema_hash"])
    sets = [c for c in paths.columns if c.startswith("avro_")]
    return spread.groupBy("schema_hash", "path").agg(
        F.bool_or("optional").alias("optional"), *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in sets], F.bool_or("recursive").alias("recursive"))


def tree_paths(registry: DataFrame) -> DataFrame:
    """`(schema_hash, path, optional, avro_types, avro_union_types, avro_enum_symbols, avro_item_types,
    avro_item_names, avro_map_value_types, recursive)` of every schema in `(schema_hash, schema_json)`.

    Records nested in unions and arrays hang their fields on the field that holds them; a null branch makes the
    field optional; maps stay leaves. A record inside itself is a leaf there, and `recursive`. Each loop turn is one
    level of schema nesting over the whole registry.
    """
    start = registry.select(
        "schema_hash", F.try_parse_json("schema_json").alias("schema"), F.lit("").alias("namespace"))
    definitions = _definitions(start)
    pending = start.select("schema_hash", F.lit("").alias("path"), "schema", "namespace", F.lit("root").alias("place"), F.array().cast("array<string>").alias("open"))
    facts = [pending.select("schema_hash", "path", F.lit("ROOT").alias("fact"), F.lit("").alias("value"))]
    resolve, expand, total = _resolving(definitions), _expanding(), F.sum(F.size("below"))
    while True:  # ends: a name is entered once on a path
        level, below = sized_with(expand(resolve(pending)), total)
        facts.append(level.select("schema_hash", "path", F.inline("facts")))
        if not below:
            break
        pending = level.select("schema_hash", "namespace", "open", F.inline("below"))
    rows = reduce(DataFrame.unionByName, facts)

    def values(fact: str, name: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("fact") == fact, F.col("value")))).alias(name)

    return rows.groupBy("schema_hash", "path").agg(
        F.bool_or((F.col("fact") == "UNION") & (F.col("value") == "NULL")).alias("optional"),
        values("TYPE", "avro_types"), values("UNION", "avro_union_types"), values("SYMBOL", "avro_enum_symbols"),
        values("ITEM", "avro_item_types"), values("ITEM_NAME", "avro_item_names"), values("MAP_VALUE", "avro_map_value_types"),
        F.bool_or(F.col("fact") == "RECURSIVE").alias("recursive"),
    )


def _resolving(definitions: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A step that unwraps `{"type": {...}}`, then puts definitions in place of type names.

    Steps are made once and applied at every level: their columns are the same there, and many to build.
    """
    schema = F.col("schema")
    wrapped = _is(schema, "OBJECT<") & ~_is(_part(schema, "type"), "STRING")
    unwrapped = F.when(wrapped, _part(schema, "type")).otherwise(schema)
    name = F.when(_is(schema, "STRING"), schema.try_cast("string")).when(
        _is(schema, "OBJECT<"), _text(schema, "type"))
    complex_types = [*NAMED, "array", "map"]
    reference = F.when(~name.isin(*PRIMITIVES, *complex_types), _full_name(name, F.col("namespace")))
    found = ["schema_hash", "path", "place", "open",
             F.coalesce("definition", "schema").alias("schema"), F.coalesce("defined_in", "namespace").alias("namespace")]
    namespace, kind = _namespace(schema, F.col("namespace")), _type_name(schema)
    own = F.when(F.col("type") == "record", _full_name(_text(schema, "name"), F.col("namespace")))

    def step(pending: DataFrame) -> DataFrame:
        rows = pending.withColumn("schema", unwrapped).withColumn("full_name", reference)
        rows = rows.join(definitions, ["schema_hash", "full_name"], "left").select(*found)
        return rows.withColumn("namespace", namespace).withColumn("type", kind).withColumn("own", own)

    return step


def _expanding() -> Callable[[DataFrame], DataFrame]:
    """A step that gives `facts` about the node a schema stands for, and the schemas `below` it."""
    schema, kind, place = F.col("schema"), F.col("type"), F.col("place")
    upper = F.upper(kind)
    fact = F.when(place == "field", "TYPE").when(place == "union", "UNION").when(place == "item", "ITEM")

    def entries(fact_name: Column, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(fact_name.alias("fact"), v.alias("value")))

    none = F.array().cast("array<struct<fact:string,value:string>>")
    own = F.when(fact.isNotNull(), entries(fact, F.array(upper))).otherwise(none)
    symbols = F.when((kind == "enum") & place.isin("field", "item"),
                     entries(F.lit("SYMBOL"), F.try_variant_get(schema, "$.symbols", "array<string>"))).otherwise(none)
    item_name = F.when(place == "item", entries(F.lit("ITEM_NAME"), F.array(
        F.coalesce(F.when(kind.isin(*NAMED), F.regexp_extract(_text(schema, "name"), r"[^.]+$", 0)), kind)))).otherwise(none)
    map_values = _part(schema, "values")
    branches = F.coalesce(map_values.try_cast(_ARRAY), F.array().cast(_ARRAY))
    map_types = F.when((kind == "map") & (place == "field"), entries(F.lit("MAP_VALUE"), F.array_distinct(F.concat(
        F.array(F.upper(_type_name(map_values))), F.transform(branches, lambda b: F.upper(_type_name(b))))))).otherwise(none)
    again = F.coalesce(F.array_contains("open", F.col("own")), F.lit(False))
    recursive = F.when(again, entries(F.lit("RECURSIVE"), F.array("own"))).otherwise(none)
    facts = F.concat(own, symbols, item_name, map_types, recursive).alias("facts")

    below = "array<struct<path:string,schema:variant,place:string>>"
    nothing = F.array().cast(below)
    fields = F.transform(F.try_variant_get(schema, "$.fields", _ARRAY), lambda f: F.struct(
        child_path(F.col("path"), _text(f, "name")).alias("path"), _part(f, "type").alias("schema"),
        F.lit("field").alias("place")))
    union = F.transform(schema.try_cast(_ARRAY), lambda s: F.struct(
        F.col("path").alias("path"), s.alias("schema"),
        F.when(place == "field", "union").otherwise("nested").alias("place")))
    item = F.array(F.struct(
        F.col("path").alias("path"), _part(schema, "items").alias("schema"),
        F.when(place == "field", "item").otherwise("nested").alias("place")))
    following = F.when(again, nothing).when(kind == "record", fields).when(kind == "union", union).when(kind == "array", item).otherwise(nothing)
    opened = F.when(F.col("own").isNotNull(), F.array_append("open", F.col("own"))).otherwise(F.col("open")).alias("open")
    columns = ["schema_hash", "path", "namespace", opened, facts, F.coalesce(following, nothing).alias("below")]
    return lambda rows: rows.select(*columns)


def avro_structures(paths: DataFrame, used: DataFrame) -> DataFrame:
    """Avro paths per event type, through the hashes its messages carry: `used` is `(event_type, schema_hash)`."""
    trees = paths.join(used.select("event_type", "schema_hash").distinct(), "schema_hash")
    return trees.withColumn("n_trees", F.lit(1).cast("bigint")).withColumn("mask", F.lit(0)).drop("schema_hash")
