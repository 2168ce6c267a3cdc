"""Views of event types as SQL text in the catalog, created only where the text is new or has changed.

A registry (a table of snapshots) keeps the text and digest of every view. A run makes the texts that its structure
wants, leaves out those that the registry has under the same digest and the catalog has as a view, and runs
CREATE OR REPLACE VIEW for the rest. Time scopes are relative to the time of the query unless `as_of` fixes it, so an
unchanged structure gives an unchanged text.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelens.functions import messages as m
from shapelens.operators.views import ColumnClash, Node, complex_type, keys_differ_in_case, structure_trees, view_columns, view_names
from shapelens.sources.landed import SCOPE_SECONDS, rowkey_bounds
from shapelens.sources.snapshots import current, last_number, write_snapshot

VIEWS = "view_name string, event_type string, scope string, digest string, text string"


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _name(text: str) -> str:
    return "`" + text.replace("`", "``") + "`"


def _key_range(event_type: str, scope: str, as_of: datetime | None) -> str:
    low, high = rowkey_bounds(event_type, scope, as_of)
    seconds = SCOPE_SECONDS[scope]
    if seconds is None or as_of is not None:
        start = _literal(low)
    else:
        start = f"concat({_literal(event_type.upper() + '-')}, cast(unix_seconds(current_timestamp()) - {seconds} as string))"
    return f"rowkey >= {start} AND rowkey < {_literal(high)}"


def _variant_path(parts: list[str]) -> str:
    if any("'" in p and '"' in p for p in parts):
        raise ColumnClash(f"no path text can hold the key {parts[-1]!r}")
    return "$" + "".join(f"['{p}']" if "'" not in p else f'["{p}"]' for p in parts)


def typed_view_text(source: str, tree: Node, event_type: str, scope: str = "all", as_of: datetime | None = None, on_clash: str = "raise") -> str:
    """SELECT of a type's typed view over `source`, a table name or a file relation such as parquet.`path`."""
    apart = keys_differ_in_case(tree)
    columns = ["rowkey"]
    for name, node in view_columns(tree, on_clash=on_clash):
        if apart:
            value = f"try_cast(try_variant_get(event, {_literal(_variant_path(node.parts))}, 'variant') AS {complex_type(node)})"
        else:
            value = ".".join(["event", *[_name(p) for p in node.parts]])
        if len(node.parts) == 1 and node.name == m.FIELD_TIMESTAMP and not node.is_array:
            number = f"try_cast({value} AS bigint)"
            value = f"CASE WHEN length(cast({value} AS string)) < {m.MILLISECONDS_MIN_LENGTH} THEN timestamp_seconds({number}) ELSE timestamp_millis({number}) END"
        columns.append(f"{value} AS {_name(name)}")
    parsed = "try_parse_json(json)" if apart else f"from_json(json, {_literal(complex_type(tree))})"
    return f"SELECT {', '.join(columns)} FROM (SELECT rowkey, {parsed} AS event FROM {source} WHERE {_key_range(event_type, scope, as_of)})"


def wanted_views(spark: SparkSession, source: str, structure: DataFrame, as_of: datetime | None = None, on_clash: str = "raise") -> tuple[DataFrame, dict[str, str]]:
    """`(view_name, event_type, scope, digest, text)` of all types and scopes, and the reason for each type that has none."""
    trees = structure_trees(structure)
    rows, failed = [], {}
    for event_type, name in view_names(sorted(trees)).items():
        try:
            texts = {scope: typed_view_text(source, trees[event_type], event_type, scope, as_of, on_clash) for scope in SCOPE_SECONDS}
        except ColumnClash as error:
            failed[event_type] = f"no view: {type(error).__name__}"
            continue
        for scope, text in texts.items():
            view = name + ("" if scope == "all" else f"_last_{scope}")
            rows.append((view, event_type, scope, hashlib.sha256(text.encode()).hexdigest(), text))
    return spark.createDataFrame(rows, VIEWS), failed


def sync_views(spark: SparkSession, source: str, structure: DataFrame, registry: str, database: str = "default",
               as_of: datetime | None = None, on_clash: str = "raise") -> tuple[DataFrame, dict[str, str]]:
    """Bring the views of `database` up to date; `registry` is the folder of their texts.

    Returns `(view_name, event_type, scope, digest, text, status)` with `created`, `changed` or `unchanged`, and the
    reason for each type that has no view. Views of types that this run has not seen stay.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}")
    after = last_number(spark, registry)
    snapshot = current(spark, registry)
    known = snapshot.read(spark) if snapshot else spark.createDataFrame([], VIEWS)
    there = spark.sql(f"SHOW VIEWS IN {_name(database)}").where("not isTemporary").select(F.col("viewName").alias("view_name"))
    standing = known.join(there, "view_name", "left_semi").select("view_name", F.col("digest").alias("had"))
    wanted, failed = wanted_views(spark, source, structure, as_of, on_clash)
    status = F.when(F.col("had").isNull(), "created").when(F.col("had") == F.col("digest"), "unchanged").otherwise("changed")
    compared = wanted.join(standing, "view_name", "left").withColumn("status", status).drop("had")
    todo = compared.where("status <> 'unchanged'").collect()  # texts of new and changed types only
    for view in todo:
        try:
            spark.sql(f"CREATE OR REPLACE VIEW {_name(database)}.{_name(view.view_name)} AS {view.text}")
        except (AnalysisException, ParseException) as error:
            failed[view.event_type] = f"no view: {type(error).__name__}"
    good = compared.where(~F.col("event_type").isin(list(failed))) if failed else compared
    # what is returned must not look at the catalog again, which now has these views
    result = spark.createDataFrame(good.collect(), f"{VIEWS}, status string") if todo else good.withColumn("status", F.lit("unchanged"))
    if todo:
        others = known.join(wanted.select("view_name"), "view_name", "left_anti")
        write_snapshot(others.unionByName(result.drop("status")).coalesce(1), registry, "views", after)
    return result, failed


def count_catalog_views(spark: SparkSession, views: DataFrame, database: str = "default") -> DataFrame:
    """`(view_name, n_rows)`, counted through each view."""
    names = [r.view_name for r in views.select("view_name").orderBy("view_name").collect()]
    if not names:
        return spark.createDataFrame([], "view_name string, n_rows bigint")
    return spark.sql(" UNION ALL ".join(
        f"SELECT {_literal(n)} AS view_name, count(*) AS n_rows FROM {_name(database)}.{_name(n)}" for n in names))
