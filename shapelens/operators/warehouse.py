"""Warehouse columns, load mappings and incremental typed loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shapelens.functions import types as t
from shapelens.functions.naming import split_path, unescape, warehouse_column
from shapelens.operators.views import ColumnClash, variant_at

# Bounds of a load and the index-0 entry of every mapping.
FIRST_MARK_SUFFIX = "-0"
END_SUFFIX = "-F"
RUN_ID_COLUMN = "meta_CreateProcessID"
RUN_ID_NAME = "_RUN_ID"


def _leaves(structure: DataFrame) -> DataFrame:
    """Leaf paths: those that are no path's parent."""
    return structure.where("is_leaf").withColumn("column_name", warehouse_column(F.col("path")))


def check_clashes(structure: DataFrame) -> None:
    """Raise when two leaves of a type give the same column name, whatever its case."""
    clash = _leaves(structure).groupBy("event_type", F.lower("column_name").alias("c")).count().where("count > 1").first()
    if clash:
        raise ColumnClash(f"{clash['count']} leaves of {clash['event_type']!r} flatten to column {clash['c']!r}")


def warehouse_columns(structure: DataFrame) -> DataFrame:
    """`(event_type, column_name, column_type)`; leaves without a primitive fall back to text."""
    return _leaves(structure).select(
        "event_type", "column_name", F.expr(t.translate("primitive", t.WAREHOUSE_TYPE)).alias("column_type")
    ).orderBy("event_type", "column_name")


def load_mapping(structure: DataFrame) -> DataFrame:
    """`(event_type, kv_index, target_column, source_path, data_type)`: index 0 is the run id, leaves follow from 1
    in column order."""
    leaves = _leaves(structure)
    # a type's columns are a schema, so one window group is small
    window = Window.partitionBy("event_type").orderBy("column_name", "path")
    columns = leaves.select(
        "event_type", F.row_number().over(window).alias("kv_index"), F.col("column_name").alias("target_column"),
        F.concat(F.lit("$."), unescape(F.col("path"))).alias("source_path"),
        F.expr(t.translate("primitive", t.LOAD_TYPE)).alias("data_type"),
    )
    run_id = leaves.select("event_type").distinct().select(
        "event_type", F.lit(0).alias("kv_index"), F.lit(RUN_ID_COLUMN).alias("target_column"),
        F.lit(RUN_ID_NAME).alias("source_path"), F.lit("Integer").alias("data_type"))
    return run_id.unionByName(columns).orderBy("event_type", "kv_index")


def first_mark(event_type: str) -> str:
    return event_type.upper() + FIRST_MARK_SUFFIX


def load_warehouse_increment(landed: DataFrame, structure: DataFrame, event_type: str, mark: str | None = None,
                             run_id: int = 0, created: Column | None = None, user: str = "loader") -> DataFrame:
    """Rows of one type with a row key above `mark`, as typed columns plus the meta columns of the target table.

    The two key bounds are pushed to the scan. A value that does not fit its column becomes NULL; a leaf inside an
    array has no single value and is NULL too (see `explode_arrays`).
    """
    leaves = _leaves(structure).where(F.col("event_type") == event_type).select(
        "path", "column_name", "primitive").orderBy("column_name", "path").collect()
    names = [leaf.column_name.lower() for leaf in leaves]
    if len(set(names)) < len(names):
        raise ColumnClash(f"leaves of {event_type!r} flatten to the same column")
    key = F.col("rowkey")
    rows = landed.where((key > (mark or first_mark(event_type))) & (key < event_type.upper() + END_SUFFIX))
    rows = rows.select("rowkey", F.try_parse_json("json").alias("event"))
    created = created if created is not None else F.current_timestamp()
    typed = [
        variant_at(F.col("event"), split_path(leaf.path)).try_cast(t.WAREHOUSE_SPARK_TYPE[leaf.primitive or "TEXT"])
        .alias(leaf.column_name) for leaf in leaves
    ]
    return rows.select(
        "rowkey", created.alias("meta_CreateDatetime"), F.lit(user).alias("meta_CreateUser"),
        F.lit(run_id).cast("bigint").alias(RUN_ID_COLUMN), F.lit(0).cast("tinyint").alias("meta_ProcessStateID"),
        created.alias("meta_ModifyDatetime"), F.lit(user).alias("meta_ModifyUser"),
        F.lit(None).cast("bigint").alias("meta_ModifyProcessID"), *typed,
    )


def next_mark(landed: DataFrame, event_type: str, mark: str | None = None) -> str:
    """Highest row key of the increment, or the old mark when it is empty; reads the key column only."""
    mark = mark or first_mark(event_type)
    key = F.col("rowkey")
    top = landed.where((key > mark) & (key < event_type.upper() + END_SUFFIX)).agg(F.max("rowkey")).first()[0]
    return top or mark


def append_increment(landed: DataFrame, structure: DataFrame, event_type: str, path: str, mark: str | None = None,
                     run_id: int = 0) -> str:
    """Load one increment into `path/run_id=…` and return the new mark.

    The upper bound is fixed before loading, so rows that land meanwhile wait for the next run; loading the same
    run again replaces its folder.
    """
    top = next_mark(landed, event_type, mark)
    rows = load_warehouse_increment(landed.where(F.col("rowkey") <= top), structure, event_type, mark, run_id)
    rows.write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
    return top


def pivot_parameters(parameters: DataFrame, keys: dict[str, str], by: str = "param_filter") -> DataFrame:
    """Key-value rows to one row per `by`: `keys` maps parameter keys to column names."""
    return parameters.where(F.col("parameter_key").isin(*keys)).groupBy(by).agg(
        *[F.max(F.when(F.col("parameter_key") == k, F.col("parameter_value"))).alias(c) for k, c in keys.items()])
