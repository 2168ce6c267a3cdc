"""Conversations as a trie of their turns, by truncation peeling.

A turn is a digest of role and text with the text's length; a prefix is the chained digest of its turns. So a
conversation is one narrow row: the keys of all its prefixes, longest last. Texts are read once and never shuffled.

The trie is taken apart from its deepest nodes upward, and a node's figures are complete when it comes off. Every round
finds the prefixes that a single surviving row still has. Those are nodes that nothing else can merge into any more:
they are given out, the row loses all these turns, and rows cut back to the same prefix (with the conversations that
end there) merge into one surviving node. Cutting one turn at a time would give the same nodes with a job per depth;
a turn that nobody else has is alone in its group, so such turns come off together. Rounds follow the number of
branchings below each other, not the length of conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shapelens.session import sized

ROOT = hashlib.sha256(b"").digest()[:16]
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
TURNS = "array<struct<digest:binary,size:bigint>>"
#: Conversation ids of one 2**ID_BITS range make one piece of the text that a node's digest is taken of.
ID_BITS = 10
SLICE_TURNS = 100_000


def conversation_turns(conversations: DataFrame, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`(conv_id, turns)`: the turns of each conversation in order, as digest of role and text and bytes of the text.

    Order is by turn, null first; rows of one turn go by digest. Null roles and texts are empty; rows without a
    conversation id belong to none; repeated rows are turns of their own. A conversation is one row of about 40 bytes a turn.
    """
    name, said = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(name).cast("string"), F.lit(":"), name, said), 256)), 1, 16)
    rows = conversations.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(said).cast("bigint").alias("size")).alias("t"))
    ordered = F.array_sort(F.collect_list("t"))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t.digest.alias("digest"), t.size.alias("size"))).alias("turns"))


def share_openings(turns: DataFrame, every: int = 5, below: int = 9) -> DataFrame:
    """Give conversation c the first h turns of conversation c - c % every in place of its own, h = crc32(c) % below.

    Fewer than h turns there are all taken, and none if there is no such conversation; no other turns change.
    """
    none = F.array().cast(TURNS)
    c = F.col("conv_id")
    own = turns.select("conv_id", "turns", (c - c % every).alias("opener"), (F.crc32(c.cast("string").cast("binary")) % below).cast("int").alias("h"))
    openers = turns.select(c.alias("opener"), F.slice("turns", 1, below - 1).alias("opening"))
    # at most 2 * every - 1 conversations share an opener
    joined = own.join(openers, "opener", "left")
    opening = F.slice(F.coalesce("opening", none), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(opening, rest).alias("turns"))


def _prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the digests of each row's turns: the key and the bytes of all texts of every prefix, the empty one first."""
    place = pa.list_(pa.struct([("key", pa.binary()), ("total", pa.int64())]))
    for batch in batches:
        lengths = pc.list_value_length(batch.column("turns")).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(lengths, dtype=np.int64), 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_TURNS, "right")))
            rows = batch.slice(at, to - at)
            flat = rows.column("turns").flatten()
            digests, sizes = pc.struct_field(flat, "digest").to_pylist(), pc.struct_field(flat, "size").to_pylist()
            keys, totals, last, offsets, i = [], [], [], [0], 0
            for n in lengths[at:to]:
                key, total = ROOT, 0
                keys.append(key)
                totals.append(total)
                for _ in range(n):
                    key = hashlib.sha256(key + digests[i]).digest()[:16]
                    total += sizes[i]
                    i += 1
                    keys.append(key)
                    totals.append(total)
                last.append(key)
                offsets.append(len(keys))
            values = pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(totals, pa.int64())], names=["key", "total"])
            path = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values).cast(place)
            yield pa.RecordBatch.from_arrays([rows.column("conv_id"), pa.array(last, pa.binary()), path], names=["conv_id", "key", "path"])
            at = to


def prefixes(turns: DataFrame) -> DataFrame:
    """`(conv_id, key, path)`: `path` has key and total text bytes of each prefix, `key` is that of the whole conversation."""
    return turns.select("conv_id", "turns").mapInArrow(_prefixes, "conv_id bigint, key binary, path array<struct<key:binary,total:bigint>>")


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over its pieces in order, which may span batches; holds one batch and one hash state."""
    key, state = None, None
    for batch in batches:
        keys, found = [], []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("piece").to_pylist()):
            if k != key:
                if state is not None:
                    keys.append(key)
                    found.append(state.hexdigest())
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.string())], names=["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])


def end_digests(ended: DataFrame) -> DataFrame:
    """`(key, ends_sha256)`: SHA-256 of the comma-joined ascending ids of the conversations that end at each node.

    Ids of one range are joined first, so that a node where a third of all conversations end is a few pieces of text,
    which one task reads in order without holding them.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = ended.groupBy("key", F.shiftright("conv_id", ID_BITS).alias("range")).agg(ids.alias("piece"))
    return pieces.repartition("key").sortWithinPartitions("key", "range").select("key", "piece").mapInArrow(_digests, "key binary, ends_sha256 string")


def _tops(rows: DataFrame) -> DataFrame:
    """Add `top`: the least depth of a row whose prefix no other row has; null where even its own node is shared."""
    places = rows.select(F.col("key").alias("id"), F.posexplode("path").alias("depth", "place")).select("id", "depth", F.col("place.key").alias("at"))
    alone = places.groupBy("at").agg(F.count("*").alias("n"), F.first("id").alias("key"), F.first("depth").alias("depth")).where("n = 1")
    return rows.join(alone.groupBy("key").agg(F.min("depth").alias("top")), "key", "left")


def _given_out(rows: DataFrame) -> DataFrame:
    """Nodes that a round completes: the row's own node and those above it down to `top`, which are its only ancestors' children."""
    total = lambda d: F.when(d >= 0, F.get("path", d)["total"]).otherwise(F.lit(0))
    depth = F.col("depth")
    return rows.where("top is not null").withColumn("end", F.size("path") - 1).withColumn("depth", F.explode(F.sequence("top", "end"))).select(
        F.get("path", depth)["key"].alias("key"), F.when(depth > 0, F.get("path", depth - 1)["key"]).alias("parent_key"),
        "conv_id", depth.cast("bigint").alias("depth"), "n_convs", F.when(depth == F.col("end"), F.col("n_children")).otherwise(F.lit(1)).alias("n_children"),
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("bigint").alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * (total(F.col("end")) - total(depth - 1))).alias("saved_tokens"),
        (depth == F.col("top")).alias("is_top"), (depth == F.col("end")).alias("is_end"))


def _cut_back(rows: DataFrame) -> DataFrame:
    """Rows without their completed turns, merged with the others that now have the same prefix."""
    done = F.col("top").isNotNull()
    top = F.when(done, F.col("top")).otherwise(F.size("path"))
    end = F.get("path", F.size("path") - 1)["total"]
    before = F.when(top > 0, F.get("path", top - 1)["total"]).otherwise(F.lit(0))
    saved = F.when(done, F.col("saved") + (F.col("n_convs") - 1) * (end - before)).otherwise(F.col("saved"))
    leaves = F.when(done & (F.col("n_children") == 0), 1).otherwise(F.col("n_leaves"))
    cut = rows.where("top is null or top > 0").select(
        F.slice("path", F.lit(1), top).alias("path"), "conv_id", "n_convs", F.when(done, 1).otherwise(F.col("n_children")).cast("bigint").alias("n_children"),
        leaves.cast("bigint").alias("n_leaves"), saved.alias("saved"))
    return cut.withColumn("key", F.get("path", F.size("path") - 1)["key"]).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.first("path").alias("path"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of `(conv_id, turns)` (see `conversation_turns`; ids are unique there).

    `conv_id` (smallest member), `depth`, `parent_conv_id` (null at the root), `n_convs`, `n_children`, `n_leaves`,
    `saved_tokens` (over the subtree, what members beyond the first need not read again), `ends_sha256` (members that
    end here) and the node's `key`. Conversations without turns are members of the root. No conversations: no node.
    Conversations alike in all turns merge map-side, and so do rows at one node, however many there are.
    """
    paths = sized(prefixes(turns))
    state = sized(paths.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.lit(0).cast("bigint").alias("n_children"),
        F.lit(0).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved"), F.first("path").alias("path")))
    rounds = []
    while not state.isEmpty():  # ends: the deepest node of all is in one row only, so every round cuts
        rows = sized(_tops(state))
        rounds.append(_given_out(rows))
        state = sized(_cut_back(rows))
    if not rounds:
        rounds = [_given_out(_tops(state))]
    nodes = reduce(DataFrame.unionByName, rounds)
    # only the top of what came off together has a parent with other members, and that parent was a row's own node
    parents = nodes.where("is_end").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    tops = nodes.where("is_top").join(parents, "parent_key", "left")
    inner = nodes.where("not is_top").withColumn("parent_conv_id", F.col("conv_id"))
    known = tops.select(*inner.columns).unionByName(inner)
    return known.join(end_digests(paths.select("key", "conv_id")), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)).alias("ends_sha256"), F.hex("key").alias("key"))


def trie_report(conversations: DataFrame) -> DataFrame:
    return prefix_trie(share_openings(conversation_turns(conversations))).drop("key")
