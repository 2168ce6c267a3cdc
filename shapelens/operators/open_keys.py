"""Objects whose keys are data (user ids, dates, hosts): found by sketches of their child keys, and read as maps.

An object is open when more different keys have been seen in it than a schema would name. Keys that a fair share of its
objects have stay fields; all others become one path segment, `WILD`, so that the paths of a type stay as few as its
fields, whatever the keys hold. The sketches have a fixed size per object path and merge over runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapelens.functions.naming import parent_path, path_depth
from shapelens.session import sized

#: Path segment for any key of an open object. No key escapes to it: a star stays a star, a backslash is doubled.
WILD = r"\*"
#: Different keys from which an object is open, and the share of its objects that makes a key a field all the same.
OPEN_FROM, FIELD_SHARE = 1000, 0.01

OPEN_SCHEMA = "event_type string, opens array<string>, fields array<string>"
_SEGMENT = r"((?:[^.\\]|\\.)+)"


def is_wild(path: str) -> str:
    """SQL: the path's last segment is `WILD`."""
    return rf"({path} = r'{WILD}' or endswith({path}, r'.{WILD}'))"


def has_wild(path: str) -> str:
    """SQL: some segment of the path is `WILD`."""
    return rf"({path} rlike r'(^|\.)\\\*(\.|$)')"


def key_sketches(paths: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """`(keys, path, n_trees, sketch)`: a sketch of the keys seen in each object path of `(keys, path, n_trees)`.

    `hll_union_agg` over such rows of several runs gives the sketch of all of them.
    """
    keys = keys or ["event_type"]
    below = paths.where("path <> ''").select(*keys, parent_path(F.col("path")).alias("path"), F.col("path").alias("child"))
    return below.groupBy(*keys, "path").agg(F.hll_sketch_agg("child").alias("sketch")).join(paths.select(*keys, "path", "n_trees"), [*keys, "path"])


def open_objects(sketches: DataFrame, keys: list[str] | None = None, limit: int = OPEN_FROM) -> DataFrame:
    """`(keys, path, n_trees)` of the open objects among `key_sketches`, of each type the least deep ones.

    What lies below an open object has other paths once its keys are data, so it is looked at again then.
    """
    keys = keys or ["event_type"]
    found = sketches.where(F.hll_sketch_estimate("sketch") > limit).withColumn("_depth", path_depth(F.col("path")))
    least = found.groupBy(*keys).agg(F.min("_depth").alias("_depth"))
    return found.join(least, [*keys, "_depth"]).select(*keys, "path", "n_trees")


def opened(paths: DataFrame, known: DataFrame | None, keys: list[str] | None = None, limit: int = OPEN_FROM, share: float = FIELD_SHARE) -> DataFrame | None:
    """`known` and the open objects that `(keys, path, n_trees)` shows beyond it: `(keys, opens, fields)`; None if there are none.

    One row per type. `opens` are object paths, `fields` the children that stay fields: those that at least `share` of
    the objects have, of which there are at most 1 / share for each key that an object has on average.
    """
    keys = keys or ["event_type"]
    sketches = key_sketches(paths, keys)
    if known is not None:
        had = known.select(*keys, F.explode("opens").alias("path"))
        sketches = sketches.join(had, [*keys, "path"], "left_anti")
    new = sized(open_objects(sketches, keys, limit))
    if new.isEmpty():
        return None
    children = paths.where(f"path <> '' and not {is_wild('path')}").select(*keys, parent_path(F.col("path")).alias("path"), F.col("path").alias("field"), F.col("n_trees").alias("n"))
    kept = children.join(new, [*keys, "path"]).where(F.col("n") >= F.col("n_trees") * share).select(*keys, "field")
    rows = new.select(*keys, F.col("path").alias("open"), F.lit(None).cast("string").alias("field")).unionByName(
        kept.select(*keys, F.lit(None).cast("string").alias("open"), "field"))
    if known is not None:
        rows = rows.unionByName(known.select(*keys, F.explode("opens").alias("open"), F.lit(None).cast("string").alias("field"))).unionByName(
            known.select(*keys, F.lit(None).cast("string").alias("open"), F.explode("fields").alias("field")))
    return sized(rows.groupBy(*keys).agg(F.collect_set("open").alias("opens"), F.collect_set("field").alias("fields")))


def with_wild(rows: DataFrame, known: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows with the keys of open objects in their `path` replaced by `WILD`; `known` is `(keys, opens, fields)`."""
    keys = keys or ["event_type"]
    joined = rows.join(known.select(*keys, "opens", "fields"), keys, "left")
    child = "concat(at, if(at = '', '', '.'), s)"
    path = rf"""if(opens is null, path, aggregate(regexp_extract_all(path, r'{_SEGMENT}', 1), '',
        (at, s) -> if(array_contains(opens, at) and not array_contains(fields, {child}), concat(at, if(at = '', '', '.'), r'{WILD}'), {child})))"""
    return joined.withColumn("path", F.expr(path)).select(*rows.columns)


def open_of(structure: DataFrame) -> DataFrame:
    """`(event_type, opens, fields)` that a merged structure shows: what a run knows from the runs before it."""
    wild = structure.where(is_wild("path")).select("event_type", F.col("parent_path").alias("open"))
    fields = structure.where(f"path <> '' and not {is_wild('path')}").select("event_type", F.col("parent_path").alias("open"), F.col("path").alias("field"))
    return wild.join(fields, ["event_type", "open"], "left").groupBy("event_type").agg(
        F.collect_set("open").alias("opens"), F.collect_set("field").alias("fields"))
