"""Landed event tables: row key and JSON text, read by key range."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shapelens.session import folder_of, sized

# Seconds looked back by each time scope.
SCOPE_SECONDS = {"all": None, "day": 86400, "week": 604800}


#: Folder of the zone map inside a landed table; readers of the table skip names with an underscore.
ZONES = "_zones"


def read_landed_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("rowkey", "json")


def write_landed_events(landed: DataFrame, path: str) -> None:
    """Range-partition by row key, so that files and row groups hold narrow key ranges and key filters skip most, and
    write the zone map of the files beside them.

    Range bounds come from a sample and row keys are unique, so a type with a third of the rows spans many files.
    """
    landed.repartitionByRange("rowkey").sortWithinPartitions("rowkey").write.mode("overwrite").parquet(path)
    measure_zones(landed.sparkSession, path).coalesce(1).write.parquet(f"{path}/{ZONES}")


def _prefix(rowkey: Column) -> Column:
    """What a key has before its first dash: all keys of a type have the same, which other types may share."""
    return F.substring_index(rowkey, "-", 1)


def measure_zones(spark: SparkSession, path: str) -> DataFrame:
    """`(file, prefix, low, high, n)`: key range and rows of each file and prefix; reads the key column only."""
    keys = spark.read.parquet(path).select("rowkey", F.col("_metadata.file_path").alias("file"))
    return keys.groupBy("file", _prefix(F.col("rowkey")).alias("prefix")).agg(
        F.min("rowkey").alias("low"), F.max("rowkey").alias("high"), F.count("*").alias("n"))


def zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone map of a landed table; measured anew where it was written without one."""
    store, folder = folder_of(spark, f"{path}/{ZONES}")
    return spark.read.parquet(f"{path}/{ZONES}") if store.exists(folder) else measure_zones(spark, path)


def key_ranges(types: DataFrame, scopes: list[str], as_of: datetime | None = None) -> DataFrame:
    """`(event_type, scope, prefix, low, high)` of each type of `(event_type)` in each scope: the bounds of `rowkey_bounds`."""
    upper = F.upper("event_type")
    moment = as_of or datetime.now(timezone.utc)
    now = int((moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).timestamp())
    lows = [F.struct(F.lit(s).alias("scope"), F.lit("0" if SCOPE_SECONDS[s] is None else str(now - SCOPE_SECONDS[s])).alias("start")) for s in scopes]
    rows = types.select("event_type", F.explode(F.array(*lows)).alias("s"))
    return rows.select("event_type", "s.scope", _prefix(F.concat(upper, F.lit("-"))).alias("prefix"), F.concat(upper, F.lit("-"), "s.start").alias("low"), F.concat(upper, F.lit("-9")).alias("high"))


def _touched(spark: SparkSession, path: str, ranges: DataFrame) -> DataFrame:
    """Zones that ranges touch, and whether they lie inside: `(file, prefix, n, inside, event_type, scope, low, high)`."""
    z, r = zones(spark, path).alias("z"), ranges.alias("r")
    touched = z.join(r, (F.col("z.prefix") == F.col("r.prefix")) & (F.col("z.high") >= F.col("r.low")) & (F.col("z.low") < F.col("r.high")))
    return touched.select("z.file", "z.prefix", "z.n", ((F.col("z.low") >= F.col("r.low")) & (F.col("z.high") < F.col("r.high"))).alias("inside"),
                          "r.event_type", "r.scope", "r.low", "r.high")


def boundary_files(touched: DataFrame) -> list[str]:
    """Files that hold a zone which a range cuts: two at most for a range over a sorted table."""
    return [r.file for r in touched.where("not inside").select("file").distinct().orderBy("file").collect()]


def range_counts(spark: SparkSession, path: str, types: DataFrame, scopes: list[str], as_of: datetime | None = None) -> DataFrame:
    """`(event_type, scope, n_rows)` of all types of `(event_type)` and scopes of a landed table.

    Zones inside a range are counted by the zone map; files with a zone that a range cuts are scanned once for all
    ranges, and no others. The plan is the same for any number of types.
    """
    ranges = sized(key_ranges(types.select("event_type").distinct(), scopes, as_of))
    touched = sized(_touched(spark, path, ranges))
    counts = touched.where("inside").select("event_type", "scope", "n")
    files = boundary_files(touched)
    if files:
        keys = spark.read.schema("rowkey string").parquet(*files).select("rowkey", F.col("_metadata.file_path").alias("file"))
        cut = touched.where("not inside").select("file", "prefix", "event_type", "scope", "low", "high")
        hit = keys.withColumn("prefix", _prefix(F.col("rowkey"))).join(cut, ["file", "prefix"]).where("rowkey >= low and rowkey < high")
        counts = counts.unionByName(hit.groupBy("event_type", "scope").agg(F.count("*").alias("n")))
    total = counts.groupBy("event_type", "scope").agg(F.sum("n").alias("n"))
    return ranges.select("event_type", "scope").join(total, ["event_type", "scope"], "left").select("event_type", "scope", F.coalesce("n", F.lit(0)).alias("n_rows"))


def rowkey_bounds(event_type: str, scope: str = "all", as_of: datetime | None = None) -> tuple[str, str]:
    """Lower and upper row key of one event type; the type is upper case in row keys."""
    prefix = event_type.upper() + "-"
    seconds = SCOPE_SECONDS[scope]
    if seconds is None:
        return prefix + "0", prefix + "9"
    as_of = as_of or datetime.now(timezone.utc)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return f"{prefix}{int(as_of.timestamp()) - seconds}", prefix + "9"


def rowkey_range(landed: DataFrame, event_type: str, scope: str = "all", as_of: datetime | None = None,
                 inclusive: bool = False) -> DataFrame:
    """Rows of one event type in a time scope. `inclusive` also takes the upper bound itself."""
    low, high = rowkey_bounds(event_type, scope, as_of)
    key = F.col("rowkey")
    return landed.where((key >= low) & ((key <= high) if inclusive else (key < high)))
