"""Resolving sets of observed types to one primitive, and primitives to target types."""

from __future__ import annotations

from shapelens.functions.json_types import has_type

# Widest type first, each with the primitive it maps to (BINARY has none).
AVRO_RANK = [
    ("BYTES", "TEXT"), ("STRING", "TEXT"), ("FIXED", "TEXT"), ("ENUM", "TEXT"), ("DOUBLE", "DOUBLE"),
    ("FLOAT", "FLOAT"), ("LONG", "BIGINT"), ("INT", "INT"), ("BOOLEAN", "BOOLEAN"),
]
JSON_RANK = [("TEXTUAL", "TEXT"), ("BINARY", None), ("FLOAT", "DOUBLE"), ("INTEGER", "BIGINT"), ("BOOLEAN", "BOOLEAN")]

# Target type names per primitive; absent primitives fall back to the TEXT entry.
SPARK_TYPE = {
    "TEXT": "string", "BIGINT": "bigint", "INT": "int", "DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean",
}
WAREHOUSE_TYPE = {
    "TEXT": "NVARCHAR(255)", "BIGINT": "BIGINT", "INT": "INT", "DOUBLE": "NUMERIC(18, 5)", "FLOAT": "NUMERIC(18, 5)",
    "BOOLEAN": "BIT",
}
LOAD_TYPE = {
    "TEXT": "String", "BIGINT": "Integer", "INT": "Integer", "DOUBLE": "Number", "FLOAT": "Number",
    "BOOLEAN": "Boolean",
}
WAREHOUSE_SPARK_TYPE = {
    "TEXT": "string", "BIGINT": "bigint", "INT": "int", "DOUBLE": "decimal(18,5)", "FLOAT": "decimal(18,5)",
    "BOOLEAN": "boolean",
}


def translate(primitive: str, mapping: dict[str, str]) -> str:
    """SQL for the target name of a primitive; unknown and absent ones take the TEXT entry."""
    cases = " ".join(f"when {primitive} = '{name}' then '{target}'" for name, target in mapping.items())
    return f"case {cases} else '{mapping['TEXT']}' end"


def avro_primitive(types: str) -> str:
    """SQL for the primitive of the widest Avro type in an array of type names; NULL when none is primitive."""
    cases = " ".join(f"when array_contains({types}, '{name}') then '{target}'" for name, target in AVRO_RANK)
    return f"case {cases} end"


def json_primitive(mask: str, item: bool = False) -> str:
    def target(name: str | None) -> str:
        return "cast(null as string)" if name is None else f"'{name}'"

    cases = " ".join(f"when {has_type(mask, name, item)} then {target(to)}" for name, to in JSON_RANK)
    return f"case {cases} end"


def resolve_primitive(mask: str, avro_types: str, union_types: str) -> str:
    """Avro first (a union looks at its branches when nothing else is primitive), then JSON."""
    in_union = f"if(array_contains({avro_types}, 'UNION'), {avro_primitive(union_types)}, null)"
    return f"coalesce({avro_primitive(avro_types)}, {in_union}, {json_primitive(mask)})"


def resolve_item_primitive(mask: str, avro_item_types: str) -> str:
    return f"coalesce({avro_primitive(avro_item_types)}, {json_primitive(mask, item=True)})"
