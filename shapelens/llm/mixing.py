"""Mixing sources to target weights with hash thresholds, without sorting documents.

A document has a 60-bit hash of its id and text. Sizes are summed by source and leading hash bits; the budget of a
source falls into one bucket, and only the rows of that bucket are summed again by the next bits, until it holds a
single hash. What is left is one threshold per source, which a filter applies to each row by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shapelens.session import sized

LEVEL_BITS, LEVELS = 12, 5
WORD = r"[^\x20\x09-\x0D]+"


def source_sizes(rows: DataFrame) -> DataFrame:
    """source, source_size. A hot source shrinks to one row per task before the shuffle."""
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"))


def cyclic_weights(sizes: DataFrame, weights: list[float]) -> DataFrame:
    """Give the sources, by code point with null last, the weights in turn. Works on one row per source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    return sizes.withColumn("weight", F.element_at(values, (rank % len(weights) + 1).cast("int")))


def share_out(sizes: DataFrame, share: float, at_most: float) -> DataFrame:
    """Add `target`: `share` of all sizes by weight, never above `at_most` times the own size, the rest reshared.

    Resharing until none is above its cap has a closed form: by ascending cap per weight, sources are full as long as
    the level of what is left over the weights that are left reaches the cap. Works on one row per source.
    """
    everything = Window.partitionBy()
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * F.lit(float(at_most))
    levels = (
        sizes.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                    / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("at", F.row_number().over(Window.orderBy("ratio", F.col("source").asc_nulls_last())))
    )
    open_at = F.when(F.col("weight") * F.col("level") < F.col("cap"), F.col("at"))
    return (
        levels.withColumn("first_open", F.min(open_at).over(everything))
        .withColumn("final", F.max(F.when(F.col("at") == F.col("first_open"), F.col("level"))).over(everything))
        .select("source", "source_size", "weight",
                F.when(F.col("first_open").isNull() | (F.col("at") < F.col("first_open")), F.col("cap")).otherwise(F.col("weight") * F.col("final")).alias("target"))
    )


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """budgets: source, budget. Adds `below`, and with it: rows with hash < below come nearest to the budget.

    A source whose budget lies within no bucket (it takes nothing or everything) gets its outer limit. Equal hashes,
    which only rows of equal id and text have, stay together.
    """
    done = None
    open_ = sized(budgets.select("source", F.col("budget"), F.lit(0.0).alias("before"), F.lit(0).cast("long").alias("bucket")))
    for level in range(1, LEVELS + 1):
        shift = LEVEL_BITS * (LEVELS - level)
        rows_, o = rows.alias("r"), open_.alias("o")
        inside = rows_.join(o, F.col("r.source").eqNullSafe(F.col("o.source")) & (F.shiftright("r.hash", shift + LEVEL_BITS) == F.col("o.bucket")))
        histogram = inside.groupBy(F.col("r.source").alias("source"), F.shiftright("r.hash", shift).alias("bucket")).agg(
            F.first("o.budget").alias("budget"), F.first("o.before").alias("before"), F.sum("r.size").alias("size"),
            F.min("r.hash").alias("low"), F.max("r.hash").alias("high"))
        order = Window.partitionBy("source").orderBy("bucket")
        passed = F.col("before") + F.sum("size").over(order)
        crossing = sized(
            histogram.withColumn("end", passed).where(F.col("end") > F.col("budget"))
            .withColumn("n", F.row_number().over(order)).where("n = 1")
            .select("source", "budget", (F.col("end") - F.col("size")).alias("before"), "bucket", "size", "low", "high"))
        single = crossing.where("low = high").select(
            "source", F.when(2 * (F.col("budget") - F.col("before")) >= F.col("size"), F.col("low") + 1).otherwise(F.col("low")).alias("below"))
        done = single if done is None else done.unionByName(single)
        open_ = crossing.where("low < high").select("source", "budget", "before", "bucket")
        if open_.isEmpty():
            break
    return budgets.alias("b").join(done.alias("d"), F.col("b.source").eqNullSafe(F.col("d.source")), "left").select(
        "b.*", F.coalesce("d.below", F.lit(1 << 60)).alias("below"))


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, at_most: float = 2.0, id_column: str = "doc_id",
        text: str = "text", source: str = "source", keep: list[str] | None = None) -> DataFrame:
    """Every document with `size`, `source_size`, `target` and `copies`: how often the mix takes it (0, 1 or 2 ...).

    Size is the number of words. Whole copies of a source come first, the rest of its target is filled by hash, up
    to the document whose inclusion or not is nearer. The result depends on ids and texts only, so reruns agree.

    Null texts have size 0; a null source is a source of its own, after all others; sources of size 0 have target 0;
    rows of equal id and text share their fate; an empty table gives an empty table; other columns are left out
    unless named in `keep`, where a column called like a result gives way to it.
    """
    kept = [k for k in keep or [] if k not in (id_column, "size", "source_size", "target", "copies")]
    rows = sized(docs.select(
        F.struct(F.col(id_column), *[F.col(k) for k in kept]).alias("kept"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit(""))).cast("binary")), 1, 15), 16, 10).cast("long").alias("hash")))
    narrow = rows.select("source", "size", "hash")
    targets = sized(share_out(cyclic_weights(source_sizes(narrow), weights), share, at_most))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = targets.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    cuts = sized(thresholds(narrow, plan))
    r, c = rows.alias("r"), cuts.alias("c")
    return r.join(c, F.col("r.source").eqNullSafe(F.col("c.source"))).select(
        "r.kept.*", F.col("r.size").alias("size"), "c.source_size", "c.target",
        (F.col("c.whole") + F.when((F.col("c.budget") > 0) & (F.col("r.hash") < F.col("c.below")), 1).otherwise(0)).cast("int").alias("copies"))


def mix_report(docs: DataFrame) -> DataFrame:
    mixed = mix(docs, [3, 1, 2])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
