"""What changed since the last run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelens.functions.types import SPARK_TYPE, translate


def column_list(structure: DataFrame) -> DataFrame:
    """Leaf and array columns of each type's view: `(event_type, column_path, column_type)`."""
    kind = translate("if(is_array, item_primitive, primitive)", SPARK_TYPE)
    return structure.where("is_leaf").selectExpr(
        "event_type", "path as column_path", f"case when is_map then 'map<string,string>' when is_array then concat('array<', {kind}, '>') else {kind} end as column_type")


def view_drift(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Per type of this run: `new`, `changed` or `unchanged`, with the columns added, removed and retyped."""
    now = current.select("event_type", "column_path", F.col("column_type").alias("now"))
    before = previous.select("event_type", "column_path", F.col("column_type").alias("before"))
    both = now.join(before, ["event_type", "column_path"], "full_outer")

    def columns(condition: Column, name: str) -> Column:
        return F.array_sort(F.collect_set(F.when(condition, F.col("column_path")))).alias(name)

    per_type = both.groupBy("event_type").agg(
        columns(F.col("before").isNull(), "added"), columns(F.col("now").isNull(), "removed"),
        columns(F.col("now") != F.col("before"), "retyped"),
        F.count("now").alias("n_now"), F.count("before").alias("n_before"))
    changed = F.size("added") + F.size("removed") + F.size("retyped") > 0
    status = F.when(F.col("n_before") == 0, "new").when(changed, "changed").otherwise("unchanged")
    return per_type.where("n_now > 0").select("event_type", status.alias("status"), "added", "removed", "retyped")


def change_log(drift: DataFrame, topics: DataFrame, event_types: DataFrame, few: DataFrame | None = None,
               conflicts: DataFrame | None = None) -> DataFrame:
    """`(kind, subject, message)`: changes from drift and registry conflicts, warnings from the reports."""
    subject = F.concat(F.lit("event type "), "event_type")
    log = drift.where("status <> 'unchanged'").select(
        F.lit("change").alias("kind"), subject.alias("subject"),
        F.when(F.col("status") == "new", "view is new").otherwise("view changed").alias("message"))
    log = log.unionByName(topics.where("not is_consistent and n_events > 0").select(
        F.lit("warning").alias("kind"), F.concat(F.lit("topic "), "topic").alias("subject"),
        F.lit("report shows inconsistencies").alias("message")))
    log = log.unionByName(event_types.where("not is_consistent").select(
        F.lit("warning").alias("kind"), subject.alias("subject"), F.lit("report shows inconsistencies").alias("message")))
    if few is not None:
        log = log.unionByName(few.select(F.lit("warning").alias("kind"), "subject", "message"))
    if conflicts is not None:
        log = log.unionByName(conflicts.select(
            F.lit("change").alias("kind"), F.concat(F.lit("schema "), "schema_hash").alias("subject"),
            F.lit("more than one schema for this hash").alias("message")))
    return log
