"""JSON events to structure paths: events of one shape are counted first, then each shape is walked once.

The shape of an event is its JSON text with a stand-in for every value that keeps the value's JSON type. The count per
shape shrinks map-side to one row per shape and task, so the cost behind it follows the number of shapes and not of
events, and an event's rows never travel. The small table of shapes is written once; what is nested deeper than one
turn of the walk opens goes on from there, without another pass over anything else.

In the walk every level of nesting is one `explode` over the entries of a variant, inside code generation.

Presence must count an event once per path although array items repeat paths. The merged schema of an array already
lists each field once, so it is walked for presence while the items are walked for types. A schema that does not
list all fields (items that disagree on a type, names that need quoting) sends that array's rows down an exact
distinct count on (path, event) instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shapelens.functions.json_types import BIT, ITEM_SHIFT, json_type_bit
from shapelens.functions.naming import child_path_sql
from shapelens.operators import shapes
from shapelens.operators.open_keys import FIELD_SHARE, OPEN_FROM, has_wild, opened, with_wild
from shapelens.session import sized

_OBJECT = "map<string,variant>"
_ARRAY = "array<variant>"
_ENTRIES = "array<struct<key:string,value:variant>>"

# What a row adds to the counts of its path.
_PLAIN = 0      # outside arrays: types and presence
_TYPES = 1      # in an array: types only
_PRESENCE = 2   # field of a merged array schema: presence only
_DISTINCT = 3   # in an array without usable merged schema: types, and presence once per event

# Key that stands for "items of this array" in a merged schema; a real key of that name would be quoted there.
_ITEMS = "[]"


def _schema_fields(schema: str) -> str:
    """SQL turning `ARRAY<OBJECT<a: BIGINT>>` into a variant `{"[]": {"a": 0}}`: an object with the schema's fields."""
    braces = f"replace(replace(replace({schema}, 'OBJECT<', '{{'), 'ARRAY<', '{{{_ITEMS}: '), '>', '}}')"
    scalars = rf"regexp_replace({braces}, r': [A-Z]+(\(\d+,\d+\))?(?=[,}}])', ': 0')"
    return rf"""try_parse_json(regexp_replace({scalars}, r'([{{ ])([A-Za-z0-9_\[\]]+): ', '$1"$2": '))"""


def _descend(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One level: each undecided row keeps its own place and adds a row per field, item or merged field."""
    kept = [_name(k) for k in keys] + ["event_no", "n", "path", "item"]
    # items of an array that are arrays themselves are not entered
    rows = rows.selectExpr(
        *kept, "role", "type", "value", f"if(type is null, try_cast(value as {_OBJECT}), null) as fields",
        f"if(type is null and not item, try_cast(value as {_ARRAY}), null) as items")
    rows = rows.selectExpr(
        *kept, "role", "fields", "items", "coalesce(type, if(fields is not null, 'OBJECT<>', schema_of_variant(value))) as type")
    rows = rows.selectExpr(
        *kept, "role", "fields", "items", "type", f"items is not null and role = {_PLAIN} as starts_array",
        "not contains(type, 'VARIANT') and not contains(type, '`') as lists_all", "contains(type, 'OBJECT<') as has_fields")
    # outer: no row is lost either way, and no filter on the whole entry list is inferred
    itself = "array(struct(cast(null as string) as key, cast(null as variant) as value))"
    merged = f"""array(struct('{_ITEMS}' as key, variant_get({_schema_fields("type")}, "$['{_ITEMS}']", 'variant') as value))"""
    items = f"cast(arrays_zip(array_repeat(cast(null as string), size(items)), items) as {_ENTRIES})"
    rows = rows.selectExpr(
        *kept, "role", "type", "items is not null as of_array",
        f"if(starts_array, if(lists_all, {_TYPES}, {_DISTINCT}), role) as item_role",
        f"""explode_outer(case when fields is not null then concat({itself}, map_entries(fields))
              when starts_array and lists_all and has_fields then concat({itself}, {merged}, {items})
              when items is not null then concat({itself}, {items}) else {itself} end) as entry""")
    # a merged schema of an array inside an array is not entered either
    rows = rows.where(f"not (role = {_PRESENCE} and item and coalesce(entry.key = '{_ITEMS}', false))")
    is_item = f"(of_array or (role = {_PRESENCE} and entry.key = '{_ITEMS}'))"
    return rows.selectExpr(
        *kept[:-2],
        f"if(entry.value is null or {is_item}, path, {child_path_sql('path', 'entry.key')}) as path",
        "if(entry.value is null, item, " + is_item + ") as item",
        f"""case when entry.value is null or not of_array then role when entry.key = '{_ITEMS}' then {_PRESENCE}
              else item_role end as role""",
        "if(entry.value is null, type, null) as type", "entry.value as value")


# A shape is the text with a mark in place of every value. The mark alone is an integer; a dot, `e`, `t` or a quote behind
# it says fraction, exponent, truth value or text. Keys stay, with a mark before them, and so do numbers of 19 or more
# digits. No JSON text holds the mark itself, as control characters are escaped there.
_MARK = "\\u0001"
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_TOKENS = "|".join([
    rf'({_STRING}\s*+:)', rf'(")(?:[^"\\]++|\\.)*+"', r"-?\d++(?:\.\d++)?(e|E)[+-]?\d++", r"(-?(?=[\d.]{19})\d++(?:\.\d++)?)", r"-?\d++(\.)\d++",
    r"-?\d++", r"(t)rue|(f)alse"])
#: An item like the one before it changes neither types nor presence.
_REPEATS = rf'([\[,]\s*+)({_MARK}[".et]?+|\{{{_MARK}[^{{}}\[\]]*+\}})(?:\s*+,\s*+\2)++(?=\s*+[,\]])'


def shape_sql(text: str) -> str:
    """SQL for the shape of a JSON text: one pass of a tokenizer, and one more over what has arrays."""
    marked = rf"regexp_replace({text}, r'(?s)\s*+(?:{_TOKENS})', concat('{_MARK}', '$1$2$3$4$5$6$7'))"
    alike = f"replace(replace(m, '{_MARK}f', '{_MARK}t'), '{_MARK}E', '{_MARK}e')"
    short = f"if(contains(m, '['), regexp_replace({alike}, r'{_REPEATS}', '$1$2'), {alike})"
    return f"transform(array({marked}), m -> {short})[0]"


def event_of_shape_sql(shape: str) -> str:
    """SQL for a JSON text that has a shape: zero, one and a half, true or a text for each value."""
    keys = rf"""regexp_replace({shape}, r'{_MARK}("(?:[^"\\{_MARK}]++|\\.)*+"\s*+:)', '$1')"""
    numbers = rf"regexp_replace({keys}, r'{_MARK}(?=-?\d)', '')"
    for sign, value in {'"': '"s"', ".": "1.5", "e": "1.5", "t": "true", "": "0"}.items():
        numbers = f"replace({numbers}, '{_MARK}{sign}', '{value}')"
    return numbers


def count_shapes(events: DataFrame, keys: list[str], event: str = "event", text: str = "event_text") -> DataFrame:
    """`(keys, event, n)`: one event of each shape with the number of events that have it, written once.

    Events without a text column are taken one by one.
    """
    names = [_name(k) for k in keys]
    if text not in events.columns:
        return events.selectExpr(*names, f"{_name(event)} as event", "1L as n")
    texts = events.selectExpr(*names, f"if({_name(event)} is null, null, {_name(text)}) as shape")
    made = StructType([*[texts.schema[k] for k in keys], StructField("shape", StringType()), StructField("n", LongType())])
    counted = sized(texts.mapInArrow(shapes.counted(keys), made).groupBy(*keys, "shape").agg(F.sum("n").alias("n")))
    return counted.selectExpr(*names, "parse_json(shape) as event", "n")


def _name(column: str) -> str:
    return f"`{column}`"


def walk(shapes: DataFrame, keys: list[str], levels: int = 6) -> DataFrame:
    """Rows `(keys, event_no, n, path, role, item, mask)` of all nodes of `(keys, event, n)`, however deep.

    A turn opens `levels` levels and is written; the next one goes on from the containers that are still closed.
    """
    names = [_name(k) for k in keys]
    kept = [*names, "event_no", "n", "path", "item", "role"]
    bit = json_type_bit("type")
    todo = shapes.selectExpr(*names, "monotonically_increasing_id() as event_no", "n", "'' as path", "false as item", f"{_PLAIN} as role",
                             "cast(null as string) as type", "event as value")
    found = []
    while True:
        rows = todo
        for _ in range(levels):
            rows = _descend(rows, keys)
        rows = rows.selectExpr(*kept, "type is null as last", "coalesce(type, schema_of_variant(value)) as type", "value")
        rows = sized(rows.where("type is not null").selectExpr(
            *kept, f"case when role = {_PRESENCE} then 0 when item then shiftleft({bit}, {ITEM_SHIFT}) else {bit} end as mask",
            """last and ((startswith(type, 'OBJECT<') and type <> 'OBJECT<>') or (startswith(type, 'ARRAY<') and not item)) as closed""", "value"))
        found.append(rows.where("not closed").drop("closed", "value"))
        todo = rows.where("closed").selectExpr(*kept, "cast(null as string) as type", "value")
        if todo.isEmpty():
            return reduce(DataFrame.unionByName, found)


def _count_paths(rows: DataFrame, keys: list[str]) -> DataFrame:
    """`(keys, path, mask, n_trees)` of walked rows; below open objects and in unlisted arrays an event counts once."""
    once = f"(role = {_DISTINCT} or ({has_wild('path')} and role in ({_PLAIN}, {_PRESENCE})))"
    per_event = rows.groupBy(*keys, "path", F.expr(f"if({once} and not item, event_no, null)").alias("event_no")).agg(
        F.expr("bit_or(mask) as mask"),
        F.expr(f"sum(if(role in ({_PLAIN}, {_PRESENCE}) and not {once} and not item, n, 0L)) as n_trees"),
        F.expr(f"max(if({once} and not item, n, 0L)) as n_once"))
    return sized(per_event.groupBy(*keys, "path").agg(F.expr("bit_or(mask) as mask"), F.expr("sum(n_trees + n_once) as n_trees")))


def paths_of_shapes(shapes: DataFrame, keys: list[str] | None = None, levels: int = 6, known: DataFrame | None = None,
                    open_from: int | None = OPEN_FROM, field_share: float = FIELD_SHARE) -> DataFrame:
    """`json_paths` of what `count_shapes` gives."""
    keys = keys or ["event_type"]
    rows = walk(shapes, keys, levels)
    counts = _count_paths(rows if known is None else with_wild(rows, known, keys), keys)
    while open_from is not None:
        more = opened(counts, known, keys, open_from, field_share)
        if more is None:
            break
        known = more
        counts = _count_paths(with_wild(rows, known, keys), keys)
    return counts.where(F.col(keys[0]).isNotNull()).select(
        *keys, "path", "mask", "n_trees",
        (F.col("mask").bitwiseAND(F.lit(BIT["NULL"])) != 0).alias("optional"),
    )


def json_paths(events: DataFrame, keys: list[str] | None = None, event: str = "event", levels: int = 6, known: DataFrame | None = None,
               open_from: int | None = OPEN_FROM, field_share: float = FIELD_SHARE) -> DataFrame:
    """Path counts per key, whatever the nesting: `(keys, path, mask, n_trees, optional)`.

    An event counts once per path: outside arrays and in merged array schemas it has one row there, otherwise its rows
    are first brought together by event. `optional` is the flag of the events themselves (a JSON null was seen).

    Objects with more than `open_from` different keys are open (see `open_keys`): their keys become one segment. Each
    turn opens the least deep ones and looks again at what lies below; nothing is walked anew. `known` are those that
    earlier runs have opened; `open_from=None` looks for no others.
    """
    return paths_of_shapes(count_shapes(events, keys or ["event_type"], event), keys, levels, known, open_from, field_share)


def structures_of_shapes(shapes: DataFrame, keys: list[str] | None = None, levels: int = 6) -> DataFrame:
    """`event_structures` of what `count_shapes` gives."""
    keys = keys or ["event_type"]
    rows = walk(shapes, keys, levels).where(f"role <> {_PRESENCE}")
    # bits first, so that the text of a node cannot be read in two ways; sorted natively, decoded once per tree
    per_event = rows.groupBy(*keys, "event_no").agg(
        F.expr("max(n) as n"), F.expr("sort_array(collect_set(concat(mask, ':', path))) as encoded"))
    trees = sized(per_event.groupBy(*keys, "encoded").agg(F.sum("n").alias("n_events")))
    trees = trees.where(F.col(keys[0]).isNotNull()).withColumn("nodes", F.expr("""array_sort(transform(encoded, n -> struct(
        substring(n, instr(n, ':') + 1) as path, cast(substring_index(n, ':', 1) as int) as mask)))"""))
    return trees.select(*keys, F.sha2(F.to_json("nodes"), 256).alias("structure_id"), "nodes", "n_events")


def event_structures(events: DataFrame, keys: list[str] | None = None, event: str = "event", levels: int = 6) -> DataFrame:
    """Distinct trees per key: `(keys, structure_id, nodes, n_events)`.

    A tree is the sorted set of (path, type bits) of one event; the optional flag takes no part. The set is built once
    per shape; shapes of one set add up.
    """
    return structures_of_shapes(count_shapes(events, keys or ["event_type"], event), keys, levels)
