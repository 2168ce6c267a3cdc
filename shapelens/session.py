"""Session settings the library relies on, and size-checked intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_ROOTS: dict[str, str] = {}
#: Tables written inside `intermediates`, for each thread by itself: a stream's batch runs beside other queries.
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open_intermediates", default=())


def configure(spark: SparkSession) -> SparkSession:
    """Set the two SQL options that change results, and one for speed; everything else stays the user's choice."""
    # A repeated JSON key keeps its last value instead of failing the parse.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # Epoch arithmetic on zone-less timestamps must not depend on the machine.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # HotSpot does not compile methods over 8000 bytecodes; Spark's reference suggests this limit for it, so that
    # stages with more code run operator by operator, compiled, instead of fused and interpreted.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def folder_of(spark: SparkSession, path: str):
    """File system and path object of a folder, whatever store it is in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def shared_dir(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, which every executor can reach.

    It lies in `spark.checkpoint.dir`, or, where that is unset, in the session's warehouse, which a cluster shares as
    well; and is deleted when the driver's JVM ends.
    """
    application = spark.sparkContext.applicationId
    if application not in _ROOTS:
        parent = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
        root = f"{parent}/shapelens-{uuid.uuid4().hex}"
        store, path = folder_of(spark, root)
        store.mkdirs(path)
        store.deleteOnExit(path)
        _ROOTS[application] = root
    return _ROOTS[application]


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that `sized` writes inside the block, in this thread, when it ends: for streams, which would pile
    them up. What other threads write meanwhile is theirs."""
    own: list[str] = []
    token = _OPEN.set((*_OPEN.get(), own))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for written in own:
            store, path = folder_of(spark, written)
            store.delete(path, True)


def sized(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used for results that are far smaller than their input (path counts, sample positions, groups of copies).
    It cuts lineage in a way that survives executor loss, the wide pass behind it runs once, and the
    reader reports true file sizes, so Catalyst broadcasts it only below `spark.sql.autoBroadcastJoinThreshold`
    and shuffles it otherwise.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sized-{uuid.uuid4().hex}"
    if _OPEN.get():
        _OPEN.get()[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized_with(df: DataFrame, total: Column) -> tuple[DataFrame, int]:
    """`sized`, and the value of an aggregate over the rows, taken while they are written; for loops that end on it."""
    seen = Observation()
    table = sized(df.observe(seen, total.alias("total")))
    return table, int(seen.get["total"] or 0)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's own estimate of a result is below the session's broadcast threshold."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit
