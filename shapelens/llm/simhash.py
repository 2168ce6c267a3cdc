"""Document fingerprints: 64-bit SimHash of weighted word shingles, and all fingerprints within a Hamming radius.

Only DataFrame operations. Every shingle adds its weight to the counts of the bits that its hash sets. Two of the 64
counts share one sum of 64-bit numbers, in its lower and upper half, so a document needs 32 sums; they are built
where its words are, and one row per document and task is what a shuffle would carry.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shapelens.session import sized

BITS, HALF = 64, 32
#: Words of a term. Single words are shared by all texts of a language, three in a row hardly are.
TERM = 3
#: Blocks a fingerprint is cut into. With a radius of r, two fingerprints agree in some BLOCKS - r blocks entirely.
BLOCKS, RADIUS = 6, 3
#: Fingerprints of a bucket that are compared as they are; larger buckets are cut once more by the bits outside of their key.
BUCKET = 512
SPACE = r"[\x20\x09-\x0D]+"


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, `fingerprint` (long) and `copies` of each text; rows that all keys share are one, and copies is their number.

    A term is three words in a row, or all words of a shorter text. It weighs 1, and 1 more for each word of over
    three bytes, as short words are mostly grammar. A bit is set if the terms that set it weigh more than half.
    Null texts and texts without words have fingerprint 0. Rows of equal keys must have equal texts: votes of copies
    grow alike, so that their number changes no bit.
    """
    words = F.split(F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")), " ")
    # An outer generator: for an inner one the optimizer adds a filter that splits the text once more.
    terms = (
        rows.select(*keys, words.alias("w")).select(*keys, "w", F.posexplode_outer("w").alias("i", "word"))
        .where(F.col("i") <= F.greatest(F.size("w") - TERM, F.lit(0)))
    )
    near = [F.col("word"), *(F.get("w", F.col("i") + k) for k in range(1, TERM))]
    long = [F.coalesce((F.octet_length(w) > 3).cast("long"), F.lit(0)) for w in near]
    # A text without words has one empty word, which weighs nothing.
    weight = F.when(F.col("word") == "", F.lit(0).cast("long")).otherwise(reduce(lambda a, b: a + b, long, F.lit(1).cast("long")))
    terms = terms.select(*keys, (F.col("i") == 0).alias("begins"), F.xxhash64(*near).alias("hash"), weight.alias("weight"))
    lanes = F.lit((1 << HALF) | 1)
    votes = terms.groupBy(*keys).agg(
        F.count_if("begins").alias("copies"), F.sum("weight").alias("all"), *[F.sum(F.col("weight") * F.shiftright("hash", p).bitwiseAND(lanes)).alias(f"v{p}") for p in range(HALF)])

    def bit(votes_for: Column, place: int) -> Column:
        return F.when(2 * votes_for > F.col("all"), F.lit((1 << place) if place < 63 else -(1 << 63))).otherwise(F.lit(0).cast("long"))

    low = [bit(F.col(f"v{p}").bitwiseAND(F.lit((1 << HALF) - 1)), p) for p in range(HALF)]
    high = [bit(F.shiftrightunsigned(f"v{p}", HALF), p + HALF) for p in range(HALF)]
    return votes.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), low + high).alias("fingerprint"), "copies")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """For each choice of `blocks - radius` blocks, the bits in them, as signed 64-bit numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def finer_masks(mask: int, pieces: int) -> list[int]:
    """The bits outside of a mask, cut into as many pieces of consecutive bits, as signed 64-bit numbers."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [len(free) * i // pieces for i in range(pieces + 1)]
    masks = [sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:], strict=False)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_pairs(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """left, right, distance: all pairs of distinct fingerprints (column `fingerprint`) at most `radius` bits apart, once each.

    Permuted block tables: each fingerprint stands in one table per choice of blocks, under the bits in these. Two
    that differ in few bits meet in at least one table, and are reported by the first in which they do. With 6 blocks
    and radius 3 a key has about 32 bits, so a bucket stays small up to billions of fingerprints, but for texts made
    from one template. Of buckets of more than `bucket` fingerprints the bits outside of the key are cut into
    radius + 1 pieces: two that differ in `radius` of these bits agree in some piece entirely, so they meet in one
    of as many smaller buckets, dealt to different tasks, and are reported by the first.
    """
    every = block_masks(blocks, radius)
    finer = [finer_masks(m, radius + 1) for m in every]
    distinct = sized(prints.select("fingerprint").where(F.col("fingerprint").isNotNull()).distinct())
    tables = distinct.select("fingerprint", F.posexplode(F.array(*[F.lit(m) for m in every])).alias("table", "mask")).select(
        "fingerprint", "table", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"))
    large = sized(tables.groupBy("table", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("table", "key", F.lit(True).alias("large")))
    # A piece of -1 stands for a whole bucket.
    pieces = F.array(*[F.array(*[F.lit(m) for m in masks]) for masks in finer])
    whole = F.array(F.lit(0).cast("long"))
    dealt = tables.join(large, ["table", "key"], "left").select(
        "fingerprint", "table", "key", F.coalesce("large", F.lit(False)).alias("large"),
        F.posexplode(F.when(F.col("large"), F.get(pieces, F.col("table"))).otherwise(whole)).alias("piece", "bits"))
    dealt = dealt.withColumn("more", F.col("fingerprint").bitwiseAND(F.col("bits")))
    a, b = dealt.alias("a"), dealt.alias("b")
    differ = F.col("a.fingerprint").bitwiseXOR(F.col("b.fingerprint"))
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(every)])
    agree = F.get(pieces, F.col("a.table"))
    first_piece = F.coalesce(*[F.when(differ.bitwiseAND(F.get(agree, F.lit(i))) == 0, F.lit(i)) for i in range(radius + 1)])
    met = a.join(b, (F.col("a.table") == F.col("b.table")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.piece") == F.col("b.piece")) & (F.col("a.more") == F.col("b.more"))
                 & (F.col("a.fingerprint") < F.col("b.fingerprint")) & (F.bit_count(differ) <= radius) & (first == F.col("a.table"))
                 & (~F.col("a.large") | (first_piece == F.col("a.piece"))))
    return met.select(F.col("a.fingerprint").alias("left"), F.col("b.fingerprint").alias("right"), F.bit_count(differ).alias("distance"))


def followers(docs: DataFrame, id_column: str, size: Column, parts: int) -> DataFrame:
    """id, next_id, need: for each distinct id the next one, after the last the first, and the largest `size` of its rows.

    Ids are dealt over ranges; within a range the next row is the next id, and the first id of the following range
    closes the gap. No task sees more than a range.
    """
    ids = docs.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.max(size).alias("need"))
    # Written once: a range may be drawn differently when it is computed again.
    ranged = sized(ids.repartitionByRange(parts, "id").withColumn("part", F.spark_partition_id()))
    firsts = ranged.groupBy("part").agg(F.min("id").alias("first"))  # a row per range
    order = Window.orderBy("part")
    ends = sized(firsts.select("part", F.coalesce(F.lead("first").over(order), F.first("first").over(order)).alias("after")))
    inside = ranged.withColumn("inside", F.lead("id").over(Window.partitionBy("part").orderBy("id")))
    return inside.join(ends, "part").select("id", F.coalesce("inside", "after").alias("next_id"), "need")


def print_with_edits(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited, next_id of every document.

    The edited text has its last quarter replaced by as much of the start of the next document. Texts are shuffled
    once by id, and of each next text the needed start once more. Null texts are empty. Rows of one id are fingerprinted
    by content, and each is returned; the next document is then the one with the least text. A null id has no next document and is nobody's
    next. An empty table gives an empty table; other columns are ignored.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    quarter = F.floor(F.length("text") / 4).cast("int")
    next_ = sized(followers(texts, "id", quarter, parts))
    # Outer joins on both sides: an inner one would filter null ids first, and the texts would be shuffled once for each.
    starts = (
        texts.join(next_.select(F.col("next_id").alias("id"), F.col("id").alias("to"), "need"), "id", "left")
        .groupBy("to").agg(F.min(F.left("text", F.col("need"))).alias("start"))
    )
    whole = texts.join(starts, texts["id"] == starts["to"], "left").select(
        "id", "text", F.concat(F.left("text", F.length("text") - quarter), F.left(F.coalesce("start", F.lit("")), quarter)).alias("edited"))
    # Rows are known by their content, which is the same when a lost task runs again; equal rows are one with a number of copies.
    keys = ["id", "row", "n_chars", "edited_sha256"]
    both = whole.select(
        "id", F.xxhash64("text").alias("row"), F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))).alias("t"))
    printed = fingerprints(both.select(*keys, "t.which", "t.text"), [*keys, "which"], "text")
    pairs = printed.groupBy(*keys).agg(
        F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("fingerprint"), F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited"),
        F.max("copies").alias("copies"))
    rows = pairs.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return rows.join(next_.select("id", "next_id"), "id", "left").drop("row", "copies", "copy")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row per document, with the number of other fingerprints within the radius of its own."""
    rows = sized(print_with_edits(docs))
    following = rows.groupBy(F.col("id").alias("next_id")).agg(F.min("fingerprint").alias("next_fingerprint"))
    pairs = near_pairs(rows)
    links = pairs.select(F.explode(F.array("left", "right")).alias("fingerprint")).groupBy("fingerprint").agg(F.count("*").alias("n_near"))
    text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return (
        rows.join(following, "next_id", "left").join(links, "fingerprint", "left")
        .select(F.col("id").alias("doc_id"), "n_chars", "edited_sha256", text(F.col("fingerprint")).alias("fingerprint"), text(F.col("edited")).alias("edited_fingerprint"),
                likeness(F.col("fingerprint"), F.col("edited")).alias("near_edited"), likeness(F.col("fingerprint"), F.coalesce("next_fingerprint", "fingerprint")).alias("near_next"),
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
    )
