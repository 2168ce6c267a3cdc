"""Warehouse loads with a ledger: which key range of which type every run has loaded.

The ledger is the saved mark. It is a table of snapshots, so a load counts only once its entry is committed, two loads
at a time conflict, and a run that is loaded again replaces its rows. Rows that land below the mark after it has passed
them are found by comparing key slices, not by reading everything again.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelens.functions.naming import rowkey_timestamp
from shapelens.operators.warehouse import END_SUFFIX, first_mark, load_warehouse_increment, next_mark
from shapelens.sources.snapshots import current, last_number, write_snapshot

LEDGER = "event_type string, run_id bigint, low string, high string, n_rows bigint, folder string"
#: Seconds of key time in a slice.
SLICE_SECONDS = 86400


@dataclass(frozen=True)
class Entry:
    """One load: keys above `low` up to `high`; both are null for rows that came in late."""

    event_type: str
    run_id: int
    low: str | None
    high: str | None
    n_rows: int
    folder: str


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """All loads of the table at `path`: `(event_type, run_id, low, high, n_rows, folder)`."""
    snapshot = current(spark, f"{path}/ledger")
    return snapshot.read(spark) if snapshot else spark.createDataFrame([], LEDGER)


def _entries(spark: SparkSession, path: str, event_type: str) -> list[Entry]:
    """Loads of one type: a row per run."""
    return [Entry(**r.asDict()) for r in ledger(spark, path).where(F.col("event_type") == event_type).orderBy("run_id").collect()]


def saved_mark(spark: SparkSession, path: str, event_type: str) -> str:
    """The key up to which a type is loaded."""
    return max((e.high for e in _entries(spark, path, event_type) if e.high), default=first_mark(event_type))


def _append(rows: DataFrame, path: str, entry: tuple, after: int) -> Entry:
    spark = rows.sparkSession
    event_type, run_id, low, high = entry
    folder = f"{path}/data/{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    new = Entry(event_type, run_id, low, high, spark.read.parquet(folder).count(), folder)
    others = ledger(spark, path).where(~((F.col("event_type") == event_type) & (F.col("run_id") == run_id)))
    write_snapshot(others.unionByName(spark.createDataFrame([asdict(new)], LEDGER)).coalesce(1), f"{path}/ledger", f"{event_type}/{run_id}", after)
    return new


def load(landed: DataFrame, structure: DataFrame, event_type: str, path: str, run_id: int) -> Entry | None:
    """Load what has landed above the saved mark and commit it; None if there is nothing.

    A run that the ledger has already is loaded again over its own range and replaces what it had; later runs keep theirs.
    """
    spark = landed.sparkSession
    after = last_number(spark, f"{path}/ledger")
    own = [e for e in _entries(spark, path, event_type) if e.run_id == run_id]
    if own and own[0].high is None:
        raise ValueError(f"run {run_id} of {event_type!r} holds late rows; it has no range to load again")
    low = own[0].low if own else saved_mark(spark, path, event_type)
    high = own[0].high if own else next_mark(landed, event_type, low)
    if high == low:
        return None
    rows = load_warehouse_increment(landed.where(F.col("rowkey") <= high), structure, event_type, low, run_id)
    return _append(rows, path, (event_type, run_id, low, high), after)


def loaded(spark: SparkSession, path: str, event_type: str) -> DataFrame | None:
    """The rows that the ledger names; columns that only some runs have are null in the others."""
    folders = [e.folder for e in _entries(spark, path, event_type)]
    return spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None


def _slice(rowkey: Column) -> Column:
    """Day of the time in a key; null where there is none."""
    return F.floor(F.unix_seconds(rowkey_timestamp(rowkey)) / SLICE_SECONDS)


def late_keys(landed: DataFrame, path: str, event_type: str) -> DataFrame:
    """`(rowkey)`: keys at or below the mark that no run has loaded.

    Landed and loaded keys are counted by slice, which shrinks map-side; only slices with more landed than loaded keys
    are compared key by key.
    """
    spark = landed.sparkSession
    key = F.col("rowkey")
    below = landed.where((key > first_mark(event_type)) & (key <= saved_mark(spark, path, event_type)) & (key < event_type.upper() + END_SUFFIX)).select("rowkey", _slice(key).alias("slice"))
    had = loaded(spark, path, event_type)
    if had is None:
        return below.select("rowkey")
    have = had.select("rowkey", _slice(key).alias("slice"))
    n_landed = below.groupBy("slice").agg(F.count("*").alias("n"))
    n_loaded = have.groupBy("slice").agg(F.count("*").alias("n"))
    short = n_landed.alias("a").join(n_loaded.alias("b"), F.col("a.slice").eqNullSafe(F.col("b.slice")), "left").where("a.n > coalesce(b.n, 0)").select("a.slice")

    def inside(rows: DataFrame) -> DataFrame:
        return rows.alias("r").join(short.alias("s"), F.col("r.slice").eqNullSafe(F.col("s.slice")), "left_semi").select("rowkey")

    return inside(below).join(inside(have), "rowkey", "left_anti")


def load_late(landed: DataFrame, structure: DataFrame, event_type: str, path: str, run_id: int) -> Entry | None:
    """Load the late rows as a run of their own; None if there are none. The mark stays."""
    spark = landed.sparkSession
    after = last_number(spark, f"{path}/ledger")
    if any(e.run_id == run_id for e in _entries(spark, path, event_type)):
        raise ValueError(f"run {run_id} of {event_type!r} is loaded already")
    keys = late_keys(landed, path, event_type)
    if keys.isEmpty():
        return None
    rows = load_warehouse_increment(landed.join(keys, "rowkey", "left_semi"), structure, event_type, None, run_id)
    return _append(rows, path, (event_type, run_id, None, None), after)
