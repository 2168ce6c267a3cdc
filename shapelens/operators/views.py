"""Flattened views over the landed event table, built from a merged structure."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelens.functions import messages as m
from shapelens.functions.naming import rowkey_timestamp, sanitize, split_path, view_name
from shapelens.functions.types import SPARK_TYPE
from shapelens.operators.open_keys import WILD
from shapelens.sources.landed import SCOPE_SECONDS, rowkey_bounds, rowkey_range


class ColumnClash(ValueError):
    """Two paths flatten to one column name."""


@dataclass
class Node:
    """One path of a collected structure. A structure is a schema: driver-sized by nature."""

    path: str
    parts: list[str]
    is_array: bool = False
    primitive: str | None = None
    item_primitive: str | None = None
    children: list["Node"] = field(default_factory=list)

    @property
    def name(self) -> str:
        return self.parts[-1]

    @property
    def is_wild(self) -> bool:
        return self.path == WILD or self.path.endswith("." + WILD)

    @property
    def values(self) -> "Node | None":
        """What an open object's keys hold; None where the keys are fields. The root is never one value."""
        return next((c for c in self.children if c.is_wild), None) if self.path else None

    @property
    def is_column(self) -> bool:
        return self.is_array or self.values is not None or not self.children


def structure_trees(structure: DataFrame) -> dict[str, Node]:
    """Collect the structures of all event types as trees, children in path order; one job."""
    rows = structure.select("event_type", "path", "parent_path", "is_array", "primitive", "item_primitive").orderBy("event_type", "path").collect()
    nodes = {(r.event_type, r.path): Node(r.path, split_path(r.path), r.is_array, r.primitive, r.item_primitive) for r in rows}
    for row in rows:
        if row.parent_path is not None:
            nodes[row.event_type, row.parent_path].children.append(nodes[row.event_type, row.path])
    return {event_type: node for (event_type, path), node in nodes.items() if path == ""}


def structure_tree(structure: DataFrame, event_type: str) -> Node:
    """The tree of one event type."""
    trees = structure_trees(structure.where(F.col("event_type") == event_type))
    if event_type not in trees:
        raise LookupError(f"no structure for event type {event_type!r}")
    return trees[event_type]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def complex_type(node: Node, map_paths: frozenset[str] = frozenset()) -> str:
    """Spark type of a node: structs of structs, arrays of structs or primitives, text where no type is known."""
    if node.path in map_paths:
        return "map<string,string>"
    if node.values is not None:
        # fields beside the keys may have other types
        inner = complex_type(node.values, map_paths) if len(node.children) == 1 else "string"
        text = f"map<string,{inner}>"
    elif node.children:
        inner = ",".join(f"{_quoted(c.name)}:{complex_type(c, map_paths)}" for c in node.children if not c.is_wild)
        text = f"struct<{inner}>"
    else:
        text = SPARK_TYPE[(node.item_primitive if node.is_array else node.primitive) or "TEXT"]
    return f"array<{text}>" if node.is_array else text


def free_name(name: str, taken: set[str], on_clash: str) -> str:
    """`name`, or with `on_clash="suffix"` the next numbered one, that differs from all taken ones in more than case."""
    if name.lower() in taken:
        if on_clash == "raise":
            raise ColumnClash(f"more than one path flattens to column {name!r}")
        number = 2
        while f"{name}_{number}".lower() in taken:
            number += 1
        name = f"{name}_{number}"
    taken.add(name.lower())
    return name


def view_columns(tree: Node, map_paths: frozenset[str] = frozenset(), on_clash: str = "raise") -> list[tuple[str, Node]]:
    """(column name, node) of a flattened view in path order; structs are entered, arrays kept whole."""
    out: list[tuple[str, Node]] = []
    taken: set[str] = set()

    def visit(node: Node, prefix: str) -> None:
        for child in node.children:
            if child.is_wild:
                continue
            name = prefix + sanitize(child.name)
            if not child.is_column and child.path not in map_paths:
                visit(child, name + "_")
            else:
                out.append((free_name(name, taken, on_clash), child))

    visit(tree, "")
    return out


def keys_differ_in_case(node: Node) -> bool:
    """Whether an object in the tree has keys that only differ in case, which no struct type can tell apart."""
    names = [c.name.lower() for c in node.children]
    return len(set(names)) < len(names) or any(keys_differ_in_case(c) for c in node.children)


def flatten_typed(landed: DataFrame, structure: DataFrame | Node, event_type: str, scope: str = "all",
                  as_of: datetime | None = None, map_paths=(), on_clash: str = "raise") -> DataFrame:
    """Typed view: JSON parsed once with the structure's type, one column per leaf or array.

    The key range sits next to the scan, and the parser reads only the fields that a query on the view uses.
    """
    tree = structure if isinstance(structure, Node) else structure_tree(structure, event_type)
    maps = frozenset(map_paths)
    apart = keys_differ_in_case(tree)
    parsed = F.try_parse_json("json") if apart else F.from_json("json", complex_type(tree, maps))
    rows = rowkey_range(landed, event_type, scope, as_of).select("rowkey", parsed.alias("event"))
    columns = []
    for name, node in view_columns(tree, maps, on_clash):
        if apart:
            value = variant_at(F.col("event"), node.parts).try_cast(complex_type(node, maps))
        else:
            value = F.col(".".join(["event", *[_quoted(p) for p in node.parts]]))
        if len(node.parts) == 1 and node.name == m.FIELD_TIMESTAMP and not node.is_array:
            value = m.event_timestamp(value)
        columns.append(value.alias(name))
    return rows.select("rowkey", *columns)


def variant_at(value: Column, parts: list[str]) -> Column:
    """The variant below some keys, whatever characters they have: no path text can hold both kinds of quotes."""
    step: list[str] = []
    for part in [*parts, None]:
        if part is not None and not ("'" in part and '"' in part):
            step.append(f"['{part}']" if "'" not in part else f'["{part}"]')
            continue
        if step:
            value = F.try_variant_get(value, "$" + "".join(step), "variant")
            step = []
        if part is not None:
            value = F.get(F.map_values(F.map_filter(value.try_cast("map<string,variant>"), lambda k, _: k == part)), F.lit(0))  # noqa: B023
    return value


def variant_text(value: Column) -> Column:
    """Scalars as their text, objects and arrays as JSON, a JSON null as NULL."""
    shape = F.schema_of_variant(value)
    nested = shape.startswith("OBJECT<") | shape.startswith("ARRAY<")
    return F.when(nested, F.to_json(value)).otherwise(value.try_cast("string"))


def flatten_untyped(landed: DataFrame, structure: DataFrame | Node, event_type: str, scope: str = "all",
                    as_of: datetime | None = None, on_clash: str = "raise") -> DataFrame:
    """Untyped view: VARIANT columns, the row key and the time it holds; both key bounds included."""
    tree = structure if isinstance(structure, Node) else structure_tree(structure, event_type)
    rows = rowkey_range(landed, event_type, scope, as_of, inclusive=True).select(
        "rowkey", F.try_parse_json("json").alias("event"))
    columns = [variant_at(F.col("event"), n.parts).alias(c) for c, n in view_columns(tree, on_clash=on_clash)]
    return rows.select(F.col("rowkey").alias("row_key"), rowkey_timestamp(F.col("rowkey")).alias("row_timestamp"), *columns)


def json_tuple_view(landed: DataFrame, structure: DataFrame | Node, event_type: str, scope: str = "all",
                    as_of: datetime | None = None, on_clash: str = "raise") -> DataFrame:
    """All leaves outside arrays as text, one `json_tuple` per nested object."""
    tree = structure if isinstance(structure, Node) else structure_tree(structure, event_type)
    rows = rowkey_range(landed, event_type, scope, as_of)
    rows = rows.select("rowkey", F.col("json").alias("_r"))
    taken = {"rowkey"}
    inner = iter(range(1_000_000))

    def expand(rows: DataFrame, node: Node, source: str, prefix: str) -> DataFrame:
        # an inner object gets a name of its own that no column can have
        names = [(c, free_name(prefix + sanitize(c.name), taken, on_clash) if c.is_column else f"-{next(inner)}") for c in node.children if not c.is_array and not c.is_wild]
        if not names:
            return rows.drop(source)
        others = [F.col(_quoted(c)) for c in rows.columns if c != source]
        rows = rows.select(*others, F.json_tuple(F.col(_quoted(source)), *[c.name for c, _ in names]).alias(*[n for _, n in names]))
        for child, name in names:
            if not child.is_column:
                rows = expand(rows, child, name, prefix + sanitize(child.name) + "_")
        return rows

    return expand(rows, tree, "_r", "")


def explode_arrays(landed: DataFrame, structure: DataFrame | Node, event_type: str, array_path: str, scope: str = "all",
                   as_of: datetime | None = None, on_clash: str = "raise") -> DataFrame:
    """One row per item of an array: its index and item fields (text) or the primitive item. Rows without the
    array stay, with NULLs. One array per view, so that arrays of one event do not multiply each other; an array
    inside the items of others is reached through them, with an index for each."""
    tree = structure if isinstance(structure, Node) else structure_tree(structure, event_type)
    rows = rowkey_range(landed, event_type, scope, as_of).select("rowkey", F.try_parse_json("json").alias("_value"))
    node, steps, kept, taken = tree, [], ["rowkey"], {"rowkey"}
    for part in split_path(array_path):
        below = [c for c in node.children if c.name == part]
        if not below:
            raise LookupError(f"no path {array_path!r} in the structure of {event_type!r}")
        node = below[0]
        steps.append(part)
        if node.is_array:
            index = free_name("_".join(sanitize(p) for p in node.parts) + "_array_index", taken, on_clash)
            items = variant_at(F.col("_value"), steps).try_cast("array<variant>")
            rows = rows.select(*[_quoted(k) for k in kept], F.posexplode_outer(items).alias(index, "_value"))
            kept, steps = [*kept, index], []
    if not node.is_array:
        raise LookupError(f"{array_path!r} is no array of {event_type!r}")
    if node.children:
        fields = [variant_text(variant_at(F.col("_value"), [c.name])).alias(free_name(f"{sanitize(node.name)}_{sanitize(c.name)}", taken, on_clash)) for c in node.children]
    else:
        kind = SPARK_TYPE[node.item_primitive or "TEXT"]
        value = variant_text(F.col("_value")) if kind == "string" else F.col("_value").try_cast(kind)
        fields = [value.alias(free_name("_".join(sanitize(p) for p in node.parts) + "_item", taken, on_clash))]
    return rows.select(*[_quoted(k) for k in kept], *fields)


def create_views(spark: SparkSession, landed: DataFrame, structure: DataFrame | Node, event_type: str,
                 as_of: datetime | None = None, typed: bool = True, on_clash: str = "raise", name: str | None = None) -> list[str]:
    """Session views of one event type in all three scopes; returns their names."""
    tree = structure if isinstance(structure, Node) else structure_tree(structure, event_type)
    build = flatten_typed if typed else flatten_untyped
    made = {(name or view_name(event_type)) + ("" if scope == "all" else f"_last_{scope}"): build(landed, tree, event_type, scope, as_of, on_clash=on_clash)
            for scope in SCOPE_SECONDS}
    for view, rows in made.items():
        rows.createOrReplaceTempView(view)
    return list(made)


def view_names(event_types: list[str]) -> dict[str, str]:
    """A view name for each type. Types whose names are alike, also with the suffix of a scope, get a checksum of their own text."""
    suffixes = ["" if scope == "all" else f"_last_{scope}" for scope in SCOPE_SECONDS]
    wanted = Counter(view_name(t) + suffix for t in event_types for suffix in suffixes)
    alike = {t for t in event_types if any(wanted[view_name(t) + suffix] > 1 for suffix in suffixes)}
    return {t: view_name(t) + (f"_{zlib.crc32(t.encode()):08x}" if t in alike else "") for t in event_types}


def create_all_views(spark: SparkSession, landed: DataFrame, structure: DataFrame, as_of: datetime | None = None,
                     typed: bool = True, on_clash: str = "raise") -> tuple[dict[str, str], dict[str, str]]:
    """Views of all types of a structure: (view name by type, reason by type that has none). One type's failure leaves
    the others alone."""
    trees = structure_trees(structure)
    names, failed = view_names(sorted(trees)), {}
    for event_type, name in list(names.items()):
        try:
            create_views(spark, landed, trees[event_type], event_type, as_of, typed, on_clash, name)
        except (ColumnClash, AnalysisException, ParseException) as error:
            failed[event_type] = f"no view: {type(error).__name__}"
            del names[event_type]
    return names, failed


def count_views(spark: SparkSession, names: dict[str, str], scope: str = "day") -> DataFrame:
    """`(event_type, day_count)`: rows of each type's view in a scope, counted through the view.

    Each view reads its own key range, so over a landed table all counts together read it about once.
    """
    suffix = "" if scope == "all" else f"_last_{scope}"
    counts = [spark.table(name + suffix).agg(F.count("*").alias("day_count")).select(F.lit(event_type).alias("event_type"), "day_count") for event_type, name in names.items()]
    if not counts:
        return spark.createDataFrame([], "event_type string, day_count bigint")
    return reduce(DataFrame.unionByName, counts)


def scope_counts(landed: DataFrame, event_types: list[str], scopes: list[str], as_of: datetime | None = None) -> DataFrame:
    """`(event_type, scope, n_rows)` of all types and scopes from one scan.

    A row key is matched by the texts before each of its dashes, so the plan does not grow with the number of types.
    """
    spark = landed.sparkSession
    bounds = spark.createDataFrame(
        [(t, t.upper(), s, *rowkey_bounds(t, s, as_of)) for t in event_types for s in scopes], "event_type string, prefix string, scope string, low string, high string")
    parts = F.split("rowkey", "-")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "-"))
    keys = landed.select("rowkey").where(F.contains("rowkey", F.lit("-"))).select("rowkey", F.explode(prefixes).alias("prefix"))
    inside = keys.join(bounds, "prefix").where((F.col("rowkey") >= F.col("low")) & (F.col("rowkey") < F.col("high")))
    counts = inside.groupBy("event_type", "scope").agg(F.count("*").alias("n"))
    return bounds.select("event_type", "scope").join(counts, ["event_type", "scope"], "left").select("event_type", "scope", F.coalesce("n", F.lit(0)).alias("n_rows"))


def day_count(landed: DataFrame, event_types: list[str], scope: str = "day", as_of: datetime | None = None) -> DataFrame:
    """Rows per event type in a scope."""
    return scope_counts(landed, event_types, [scope], as_of).select("event_type", F.col("n_rows").alias("day_count"))
