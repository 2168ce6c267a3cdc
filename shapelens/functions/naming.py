"""Paths, column names and row keys."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# A path joins escaped key names with dots, so that the key `a.b` and the key `b` inside `a` stay apart.
# The root is the empty path; an empty key is written `\0`.
_LAST_NAME = r"((?:[^.\\]|\\.)*)$"


def escape_name(name: Column) -> Column:
    escaped = F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("."), F.lit("\\."))
    return F.when(name == "", F.lit("\\0")).otherwise(escaped)


def child_path(parent: Column, name: Column) -> Column:
    return F.when(parent == "", escape_name(name)).otherwise(F.concat(parent, F.lit("."), escape_name(name)))


def child_path_sql(parent: str, name: str) -> str:
    """`child_path` as SQL text, for expressions repeated over many levels."""
    escaped = rf"if({name} = '', r'\0', replace(replace({name}, r'\', r'\\'), '.', r'\.'))"
    return f"if({parent} = '', {escaped}, concat({parent}, '.', {escaped}))"


def unescape(path: Column) -> Column:
    return F.regexp_replace(F.replace(path, F.lit("\\0"), F.lit("")), r"\\(.)", "$1")


def parent_path(path: Column) -> Column:
    """Path of the parent; NULL for the root, the empty path for top-level fields."""
    return F.when(path == "", F.lit(None).cast("string")).otherwise(
        F.regexp_replace(F.regexp_replace(path, _LAST_NAME, ""), r"\.$", "")
    )


def last_name(path: Column) -> Column:
    return unescape(F.regexp_extract(path, _LAST_NAME, 1))


def path_depth(path: Column) -> Column:
    plain = F.regexp_replace(path, r"\\.", "x")
    return F.when(path == "", F.lit(0)).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit("."), F.lit(""))) + 1)


def split_path(path: str) -> list[str]:
    """Key names of a path, unescaped; driver side, for building view columns."""
    if path == "":
        return []
    parts = re.findall(r"(?:[^.\\]|\\.)+", path)
    return ["" if p == "\\0" else re.sub(r"\\(.)", r"\1", p) for p in parts]


def sanitize_name(name: Column) -> Column:
    """Column name for a typed view: letters, digits, dot, underscore, dollar and blank survive."""
    return F.regexp_replace(name, r"[^a-zA-Z0-9._$ ]", "")


def sanitize(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9._$ ]", "", name)


def view_name(event_type: str) -> str:
    """Spark view names allow letters, digits and underscores only, and start with a letter."""
    name = re.sub(r"[^a-z0-9_]", "_", event_type.lower())
    return name if name[:1].isalpha() else f"event_{name}"


def warehouse_column(path: Column) -> Column:
    return F.replace(unescape(path), F.lit("."), F.lit("_"))


def rowkey_timestamp(rowkey: Column) -> Column:
    """Time held in `<TYPE>-<10-digit epoch seconds>...`."""
    seconds = F.substr(rowkey, F.instr(rowkey, "-") + F.lit(1), F.lit(10)).try_cast("bigint")
    return F.timestamp_seconds(seconds)
