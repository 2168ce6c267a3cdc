"""JSON types as bits of one integer.

A node of a structure tree carries a *set* of JSON types and a set of array item types. Kept as a bit mask, both
sets merge with `bit_or`, which is a fixed-width aggregation buffer: Spark hash-aggregates it map-side.

Expressions here are SQL text over column names: one gateway call each, however many branches they have.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The JSON type names, in bit order.
JSON_TYPES = ["ARRAY", "BINARY", "BOOLEAN", "FLOAT", "INTEGER", "NULL", "OBJECT", "TEXTUAL", "UNKNOWN"]

BIT = {name: 1 << position for position, name in enumerate(JSON_TYPES)}
ITEM_SHIFT = len(JSON_TYPES)


def json_type_bit(schema: str) -> str:
    """SQL for the bit of the JSON type that a `schema_of_variant` text stands for.

    Decimals are floating point, unless they have no fraction digits and more digits than a BIGINT holds:
    those are integers too large for 64 bits.
    """
    # Two-digit precisions compare as text.
    big_integer = f"endswith({schema}, ',0)') and length({schema}) = {len('DECIMAL(19,0)')} and {schema} >= 'DECIMAL(19,0)'"
    return f"""case when {schema} = 'STRING' then {BIT['TEXTUAL']} when {schema} = 'BIGINT' then {BIT['INTEGER']}
        when startswith({schema}, 'DECIMAL(') then if({big_integer}, {BIT['INTEGER']}, {BIT['FLOAT']})
        when {schema} in ('DOUBLE', 'FLOAT') then {BIT['FLOAT']} when {schema} = 'BOOLEAN' then {BIT['BOOLEAN']}
        when {schema} = 'VOID' then {BIT['NULL']} when startswith({schema}, 'OBJECT<') then {BIT['OBJECT']}
        when startswith({schema}, 'ARRAY<') then {BIT['ARRAY']} when {schema} = 'BINARY' then {BIT['BINARY']}
        else {BIT['UNKNOWN']} end"""


def has_type(mask: str, name: str, item: bool = False) -> str:
    return f"({mask} & {BIT[name] << (ITEM_SHIFT if item else 0)}) <> 0"


def types_in(mask: str, item: bool = False) -> Column:
    """Names of the types in a mask column, sorted, as an array."""
    names = ", ".join(f"if({has_type(mask, n, item)}, '{n}', null)" for n in JSON_TYPES)
    return F.expr(f"array_compact(array({names}))")
