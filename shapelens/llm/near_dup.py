"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

Shingles are five words. A first pass over the texts counts, in a table of fixed width, the documents that hold each
shingle; a second one samples each document's weighted shingles (Ioffe's ICWS) and emits hashes of bands of samples.
Documents of one content are one node from there on. Nodes that share a band are candidates, weighted Jaccard
similarity of the whole texts, by the weights that samples are drawn with, decides, and connected nodes form a class. Nothing but the table of counts, whose
size does not depend on the data, reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelens.llm.texts import WordHashes, mix, slices, utf8
from shapelens.session import sized

SHINGLE, SIMILARITY = 5, 0.8
#: 16 bands of 4 samples: a pair at the threshold is missed with probability (1 - 0.8^4)^16 = 0.0002.
BANDS, ROWS = 16, 4
#: Cells of the table of document counts. It resolves shingles that stand in more than about a 500th of documents,
#: whatever their number is, as both the counts and the noise of shared cells grow with it. Rarer ones count as rare.
CELLS_LOG2 = 18
#: Weight of a shingle: its count in the text times 1 + DAMP * log10(documents / documents that hold it). The logarithm
#: is damped, so that copies that are a large part of all documents do not lose what they share. Samples are drawn with
#: the same weights, so two texts agree in a sample with the probability of their similarity, however large their group.
DAMP = 0.1
#: One in so many documents is as rare as a shingle can be: the noise of the table would hide more.
RAREST = 1000
#: Documents added to the number of documents, so that in a few documents nothing counts as common.
PRIOR = 200
#: Bits of the bitmap of rows whose texts are looked at again.
SLOTS_LOG2 = 23
#: Nodes of a crowd are compared in blocks of so many.
BLOCK = 256
#: The nodes of one rare shingle are dealt over so many groups before these are connected.
SALTS = 16
#: In joins, rows of one value beyond so many are dealt over more tasks.
SPREAD = 1000

_LOW = np.uint64((1 << 44) - 1)
_STEPS = [np.uint64(pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) | 1) for i in range(SHINGLE)]
PIECE = 1 << 19


@dataclass
class Shingles:
    """Distinct shingles (44-bit hashes) of some documents, sorted within each, with counts; starts has n + 1 entries."""

    hashes: np.ndarray
    counts: np.ndarray
    starts: np.ndarray


class Shingler:
    def __init__(self) -> None:
        self.words = WordHashes()

    def __call__(self, column: pa.Array) -> Shingles:
        words, starts = self.words(*utf8(column))
        n = np.diff(starts)
        combined = words * _STEPS[0]
        for i in range(1, SHINGLE):
            combined[:-i or None] += words[i:] * _STEPS[i] if len(words) > i else np.uint64(0)
        doc = np.repeat(np.arange(len(n)), n)
        left = starts[1:][doc] - np.arange(len(words))  # words from here to the end of the document
        full = left >= SHINGLE
        # A text of fewer words is one shingle.
        short = np.flatnonzero((n > 0) & (n < SHINGLE))
        for d in short:
            at = starts[d]
            combined[at] = (words[at: at + n[d]] * np.array(_STEPS[: n[d]])).sum(dtype=np.uint64) ^ np.uint64(n[d])
        full[starts[:-1][short]] = True
        key = mix(combined[full]) & _LOW | doc[full].astype(np.uint64) << np.uint64(44)
        key.sort()
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(key)))
        key = key[at]
        return Shingles(key & _LOW, counts, np.searchsorted(key >> np.uint64(44), np.arange(len(n) + 1).astype(np.uint64)))


@dataclass
class Frequencies:
    """Number of documents with shingles, and in how many of them shingles of each cell stand."""

    documents: int
    cells: np.ndarray

    def held(self, found: Shingles) -> np.ndarray:
        return self.cells[(found.hashes >> np.uint64(44 - CELLS_LOG2)).astype(np.int64)]

    def _rare(self, found: Shingles) -> np.ndarray:
        return np.log10((self.documents + PRIOR) / np.clip(self.held(found), max(1, (self.documents + PRIOR) / RAREST), self.documents + PRIOR))

    def weights(self, found: Shingles) -> np.ndarray:
        return found.counts * (1 + DAMP * self._rare(found))


def count_shingles(docs: DataFrame, text: str = "text") -> Frequencies:
    """One pass; each task sends its table in 64 ranges of cells, which are summed range by range."""
    width = (1 << CELLS_LOG2) // 64

    def run(batches):
        shingler, cells, n = Shingler(), np.zeros(1 << CELLS_LOG2, np.int64), 0
        for part in slices(batches, "text", PIECE):
            found = shingler(part.column("text"))
            cells += np.bincount((found.hashes >> np.uint64(44 - CELLS_LOG2)).astype(np.int64), minlength=1 << CELLS_LOG2)
            n += int((np.diff(found.starts) > 0).sum())
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(64), pa.int32()), pa.array([n] + [0] * 63, pa.int64()), pa.array([cells[i * width: (i + 1) * width].astype("<u4").tobytes() for i in range(64)], pa.binary())],
                names=["part", "n", "cells"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for blob in table.column("cells"):
            total += np.frombuffer(blob.as_py(), "<u4")
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()),
                         "cells": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, n long, cells binary"
    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, schema).groupBy("part").applyInArrow(add, schema).collect()
    cells = np.zeros(1 << CELLS_LOG2, np.int64)
    for row in rows:
        cells[row["part"] * width: (row["part"] + 1) * width] = np.frombuffer(row["cells"], np.int64)
    return Frequencies(sum(row["n"] for row in rows), cells)


class Sampler:
    """ICWS: for each document and sample, the shingle (and its level of weight) whose draw is the least.

    The draws of a shingle are quantiles of fixed tables, chosen by bits of its hash, so all tasks draw alike.
    """

    def __init__(self, samples: int = BANDS * ROWS):
        random = np.random.default_rng(20240229)
        self.r = random.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
        self.log_c = np.log(random.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
        self.seeds = random.integers(1, 1 << 63, samples, np.int64).astype(np.uint64)

    def __call__(self, found: Shingles, weights: np.ndarray) -> np.ndarray:
        """A row of sample hashes for each document that has shingles."""
        sizes = np.diff(found.starts)
        starts = found.starts[:-1][sizes > 0]
        sizes = sizes[sizes > 0]
        out = np.zeros((len(starts), len(self.seeds)), np.uint64)
        if not len(starts):
            return out
        log_w = np.log(weights).astype(np.float32)
        for k, seed in enumerate(self.seeds):
            h = mix(found.hashes + seed)
            r = self.r[(h >> np.uint64(48)).astype(np.int32)]
            beta = ((h & np.uint64(0xFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(1 / 65536)
            level = np.floor(log_w / r + beta)
            draw = self.log_c[(h >> np.uint64(24) & np.uint64(0xFFFF)).astype(np.int32)] - r * (level - beta + np.float32(1))
            least = np.flatnonzero(draw == np.repeat(np.minimum.reduceat(draw, starts), sizes))
            at = least[np.searchsorted(least, starts)]
            out[:, k] = mix(h[at] + level[at].astype(np.int64).astype(np.uint64))
        return out


def _content(found: Shingles, column: pa.Array) -> list[bytes | None]:
    """16 bytes that tell contents apart: equal for texts of equal shingles and counts; for texts without words by the text."""
    out: list[bytes | None] = []
    a = mix(found.hashes * np.uint64(0x9FB21C651E98DF25) + found.counts.astype(np.uint64))
    b = mix(a ^ np.uint64(0xA24BAED4963EE407))
    for d, valid in enumerate(column.is_valid().to_pylist()):
        s, e = found.starts[d], found.starts[d + 1]
        if not valid:
            out.append(None)
        elif s == e:
            text = np.frombuffer(column[d].as_py().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)
            x = mix((text + np.uint64(257)) * mix(np.arange(1, len(text) + 1, dtype=np.uint64)))
            out.append(np.array([x.sum(dtype=np.uint64), mix(x).sum(dtype=np.uint64) + np.uint64(1)]).tobytes())
        else:
            out.append(np.array([a[s:e].sum(dtype=np.uint64), b[s:e].sum(dtype=np.uint64)]).tobytes())
    return out


def row_key(id_column: str, text: str) -> Column:
    """16 bytes that rows of equal id and text share, and no others."""
    named = F.coalesce(F.concat(F.lit("i"), F.col(id_column).cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(named, F.lit(":"), F.coalesce(F.md5(F.col(text)), F.lit("-")))))


def sketch(docs: DataFrame, frequencies: Frequencies, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """row (see `row_key`), id, node (content; null for null texts) and samples (null without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches):
        shingler, sampler = Shingler(), Sampler()
        for part in slices(batches, "text", PIECE):
            column = part.column("text")
            found = shingler(column)
            has = np.diff(found.starts) > 0
            rows = iter((sampler(found, shared.value.weights(found)) >> np.uint64(32)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("id"), pa.array(_content(found, column), pa.binary()), pa.array([next(rows) if h else None for h in has], pa.list_(pa.int32()))],
                names=["row", "id", "node", "samples"])

    rows = docs.select(row_key(id_column, text).alias("row"), F.col(id_column).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"row binary, id {rows.schema['id'].dataType.simpleString()}, node binary, samples array<int>")


def join_frequent(rows: DataFrame, few: DataFrame, column: str, how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """`rows` joined with `few`, which has one row per value of the column.

    Values that many rows have are counted first, unless `counts` has the value and `n`; their rows are dealt over as many tasks as they need, and their row
    of `few` goes to each. Rows are dealt by content, so a task that runs again deals them alike.
    """
    counts = rows.groupBy(column).agg(F.count("*").alias("n")) if counts is None else counts
    frequent = sized(counts.where(F.col("n") > SPREAD).select(column, F.floor(F.col("n") / SPREAD).cast("int").alias("_more")))
    if frequent.isEmpty():
        return rows.join(few, column, how)
    more = F.coalesce("_more", F.lit(0))
    salted = rows.join(frequent, column, "left").withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), more + 1).cast("int")).drop("_more")
    copied = few.join(frequent, column, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), more))).drop("_more")
    return salted.join(copied, [column, "_salt"], how).drop("_salt")


def bands() -> Column:
    """Hashes of the bands of `samples`."""
    return F.array(*[F.xxhash64(F.lit(i), *[F.get("samples", F.lit(j)) for j in range(i, BANDS * ROWS, BANDS)]) for i in range(BANDS)])


def similar(pairs: DataFrame, texts: DataFrame, frequencies: Frequencies, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts have at least the similarity. Works on whole texts."""
    shared = pairs.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches):
        shingler = Shingler()
        for part in slices(batches, "a_text", PIECE):
            keep = []
            one, two = shingler(part.column("a_text")), shingler(part.column("b_text"))
            w1, w2 = shared.value.weights(one), shared.value.weights(two)
            for d in range(part.num_rows):
                s1, s2 = slice(one.starts[d], one.starts[d + 1]), slice(two.starts[d], two.starts[d + 1])
                _, i, j = np.intersect1d(one.hashes[s1], two.hashes[s2], assume_unique=True, return_indices=True)
                shared_weight = np.minimum(w1[s1][i], w2[s2][j]).sum()
                keep.append(shared_weight >= (least - 1e-9) * (w1[s1].sum() + w2[s2].sum() - shared_weight))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(run, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node that is connected, for the nodes of undirected edges (a, b).

    Each round every node takes the least label around it, then the label of its label; both halve distances. Rounds
    are written to the shared folder, which also cuts lineage.
    """
    around = sized(edges.select("a", "b").union(edges.select("b", "a")).distinct().toDF("node", "other"))
    labels = sized(around.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")))
    while True:
        seen = around.join(labels.select(F.col("node").alias("other"), F.col("label").alias("offer")), "other").groupBy("node").agg(F.min("offer").alias("offer"))
        lower = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = sized(lower.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        labels = after.select("node", "label")
        if after.where(F.col("old") != F.col("label")).isEmpty():
            return labels


@dataclass
class Classes:
    """rows: row, id, node and n, how often it stands in the table; nodes: node, label; names: label, least (of the class: unnamed, id, row)."""

    rows: DataFrame
    nodes: DataFrame
    names: DataFrame


def classify(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> Classes:
    """Classes of documents: what links of at least `least` weighted Jaccard similarity connect.

    Each band's bucket is first compared with one node only, which settles groups of copies without building their
    pairs. What buckets connect but links do not is parted by what similar texts must share and then compared in full,
    in blocks that emit links only. This is one way for crowds of any size.
    """
    frequencies = count_shingles(docs, text)
    rows = sized(sketch(docs, frequencies, id_column, text))
    known = sized(rows.groupBy("row", "id", "node").agg(F.count("*").alias("n")))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")).alias("least")
    nodes = sized(rows.where(F.col("node").isNotNull()).groupBy("node").agg(first, F.first("samples").alias("samples")))

    keys = nodes.where(F.col("samples").isNotNull()).select("node", F.posexplode(bands()).alias("band", "key"))
    shared = sized(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = sized(join_frequent(keys, shared, "key", counts=shared).select("key", "band", "node", "n"))
    # What copies were made from is in the largest bucket of every band, so it is the likeliest to be near all of them.
    central = sized(members.groupBy("node").agg(F.sum("n").alias("company")))
    heads = sized(members.join(central, "node").groupBy("key").agg(F.max(F.struct("company", "node"))["node"].alias("head")))
    members = sized(join_frequent(members, heads, "key"))
    stars = members.where(F.col("node") != F.col("head")).select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    stars = sized(stars)

    used = sized(members.select("node").distinct().join(nodes.select("node", F.col("least.row").alias("row")), "node"))
    texts = sized(_texts(docs.select(row_key(id_column, text).alias("row"), F.col(text).alias("text")), used))

    links = sized(similar(stars, texts, frequencies, least))
    labels = components(links)
    crowds = _crowds(components(stars), labels)
    parts = _crowds(components(sized(_parted(crowds, texts, frequencies, least))), labels)
    labels = components(links.union(sized(_blockwise(parts, texts, frequencies, least))))
    classes = sized(nodes.select("node", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    return Classes(known, classes.select("node", "label"), sized(classes.groupBy("label").agg(F.min("least").alias("least"))))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """id, class_id: one row per document, with the least id of its class.

    Texts without words are alike only if equal; a null text is alone. Rows without id are classed like others, and a
    class of such rows only has no id. Rows of one id are classed each by its text; if they are the least of several
    classes, these share a name. Empty tables give empty tables; other columns are ignored.
    """
    found = classify(docs, id_column, text, least)
    by_node = sized(join_frequent(found.nodes, found.names, "label").select("node", F.col("least.id").alias("class_id"), F.lit(True).alias("named")))
    rows = join_frequent(found.rows, by_node, "node", "left").withColumn("class_id", F.when(F.col("named"), F.col("class_id")).otherwise(F.col("id")))
    each = rows.select("id", "class_id", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    return each.select(F.col("id").alias(id_column), "class_id")


def _texts(rows: DataFrame, used: DataFrame) -> DataFrame:
    """node, text: one row for each node in `used` (node, row), from rows (row, text).

    Most documents are near no other, so before anything is shuffled their texts are left out by a bitmap of row hashes.
    Its size is fixed: where more rows are used than it tells apart it lets more pass, and the join decides.
    """
    slot = (F.pmod(F.xxhash64("row"), F.lit(1 << SLOTS_LOG2)) + 1).alias("slot")
    bits = used.select(slot).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    wanted = np.zeros(1 << SLOTS_LOG2, bool)
    for bucket, found in bits.collect():
        part = np.unpackbits(np.frombuffer(found, np.uint8), bitorder="little").astype(bool)
        wanted[(bucket - 1) * len(part): bucket * len(part)] = part
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def run(batches):
        shingler, wanted = Shingler(), np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            chosen = batch.filter(pa.array(wanted[batch.column("slot").to_numpy() - 1]))
            for part in slices([chosen], "text", PIECE):
                column = part.column("text")
                yield pa.RecordBatch.from_arrays([pa.array(_content(shingler(column), column), pa.binary()), column], names=["node", "text"])

    found = rows.select(slot, "text").mapInArrow(run, "node binary, text string").where("node is not null")
    return found.join(used.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _crowds(crowd: DataFrame, labels: DataFrame) -> DataFrame:
    """node, label, crowd, size, minors, minor: nodes of crowds (what is connected) of several classes; minor ones are not in the largest."""
    rows = sized(crowd.withColumnRenamed("label", "crowd").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    parts = rows.groupBy("crowd", "label").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("crowd").agg(F.sum("n").alias("size"), F.count("*").alias("parts"), F.max(F.struct("n", "label")).alias("main")).where("parts > 1")
    return sized(join_frequent(rows, sized(mixed), "crowd").select("node", "label", "crowd", "size", (F.col("size") - F.col("main.n")).alias("minors"), (F.col("label") != F.col("main.label")).alias("minor")))


def _parted(crowds: DataFrame, texts: DataFrame, frequencies: Frequencies, least: float) -> DataFrame:
    """Edges (a, b) that connect all nodes of a crowd that can be similar and are of different classes.

    Shingles are ordered by how many documents hold them, rarest first. What two texts of at least the similarity share
    weighs `least` of either text, so the first shingle they share stands where at least as much is still to come: in
    the head of both. A passage that many texts share stands at their ends, and connects none that has more of its own
    than the similarity allows.
    """
    shared = crowds.sparkSession.sparkContext.broadcast(frequencies)

    def run(batches):
        shingler = Shingler()
        for part in slices(batches, "text", PIECE):
            found = shingler(part.column("text"))
            doc = np.repeat(np.arange(part.num_rows), np.diff(found.starts))
            order = np.lexsort((found.hashes, shared.value.held(found), doc))
            weights = shared.value.weights(found)[order]
            sums = np.concatenate([[0.0], np.cumsum(weights)])
            total = (sums[found.starts[1:]] - sums[found.starts[:-1]])[doc]
            to_come = sums[found.starts[1:]][doc] - sums[:-1]
            head = to_come >= (least - 1e-6) * total
            rows = pa.array(doc[head])
            yield pa.RecordBatch.from_arrays(
                [part.column(c).take(rows) for c in ("node", "label", "crowd")] + [pa.array(found.hashes[order][head].astype(np.int64))], names=["node", "label", "crowd", "shingle"])

    dealt = crowds.select("node", "label", "crowd").join(texts, "node").select("node", "label", "crowd", "text")
    heads = dealt.mapInArrow(run, "node binary, label binary, crowd binary, shingle long").select(
        "node", "label", F.xxhash64("crowd", "shingle").alias("key"), F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int").alias("salt"))
    heads = sized(heads)
    salted = sized(heads.groupBy("key", "salt").agg(F.min("node").alias("first"), F.min("label").alias("low"), F.max("label").alias("high")))
    mixed = sized(salted.groupBy("key").agg(F.min("first").alias("least"), F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("key", "least"))
    firsts = sized(salted.join(mixed, "key").select("key", "salt", "first", "least"))
    inner = heads.join(firsts, ["key", "salt"]).select(F.col("first").alias("a"), F.col("node").alias("b"))
    return inner.union(firsts.select(F.col("least").alias("a"), F.col("first").alias("b"))).distinct()


def _blockwise(crowds: DataFrame, texts: DataFrame, frequencies: Frequencies, least: float) -> DataFrame:
    """Links (a, b) of minor nodes to any node of their crowd.

    A crowd is dealt into blocks and its minor nodes once more; each pair of blocks meets in one group, which indexes
    the shingles of its residents and emits links only. So memory and output do not grow with the number of pairs.
    """
    shared = crowds.sparkSession.sparkContext.broadcast(frequencies)
    here, there = F.ceil(F.col("size") / BLOCK).cast("int"), F.ceil(F.col("minors") / BLOCK).cast("int")
    place = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    home = crowds.select("node", "crowd", F.lit(False).alias("visits"), place(here).alias("block"), every(there).alias("other"))
    visits = crowds.where("minor").select("node", "crowd", F.lit(True).alias("visits"), every(here).alias("block"), place(there).alias("other"))
    dealt = home.union(visits).join(texts, "node")

    def compare(table: pa.Table) -> pa.Table:
        shingler, a, b = Shingler(), [], []
        visiting = np.array(table.column("visits").to_pylist(), bool)
        residents = [_weighed(part, shingler, shared.value) for part in slices(table.filter(pa.array(~visiting)).select(["node", "text"]).to_batches(), "text", PIECE)]
        if residents:
            names = [n for r in residents for n in r[0]]
            at = np.concatenate([[0], np.cumsum([len(r[0]) for r in residents])])
            hashes = np.concatenate([r[1] for r in residents])
            weights = np.concatenate([r[2] for r in residents])
            owner = np.concatenate([r[3] + at[i] for i, r in enumerate(residents)])
            total = np.bincount(owner, weights, len(names))
            order = np.argsort(hashes, kind="stable")
            hashes, weights, owner = hashes[order], weights[order], owner[order]
            for part in slices(table.filter(pa.array(visiting)).select(["node", "text"]).to_batches(), "text", PIECE):
                nodes, h, w, of = _weighed(part, shingler, shared.value)
                low, high = np.searchsorted(hashes, h), np.searchsorted(hashes, h, "right")
                for d, node in enumerate(nodes):
                    mine = of == d
                    n = (high - low)[mine]
                    met = np.repeat(low[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    both = np.bincount(owner[met], np.minimum(weights[met], np.repeat(w[mine], n)), len(names))
                    for k in np.flatnonzero(both >= (least - 1e-9) * (total + w[mine].sum() - both)):
                        if names[k] != node:
                            a.append(min(names[k], node))
                            b.append(max(names[k], node))
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return dealt.groupBy("crowd", "block", "other").applyInArrow(compare, "a binary, b binary").distinct()


def _weighed(part: pa.RecordBatch, shingler: Shingler, frequencies: Frequencies):
    """Nodes, and the hash, weight and owner of each of their shingles."""
    found = shingler(part.column("text"))
    return part.column("node").to_pylist(), found.hashes, frequencies.weights(found), np.repeat(np.arange(part.num_rows), np.diff(found.starts))


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, first: whether the document is the one of its class that stays."""
    return near_duplicates(docs).withColumn("first", F.col("doc_id").eqNullSafe(F.col("class_id")))


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class: the one of least id, rows without id last, and of those the one of least digest.

    Rows of one id but different texts are different documents; rows of equal id and text are one, also where both
    are null. Columns stay as they are.
    """
    found = classify(docs, id_column, text)
    stay = found.names.select(F.col("least.row").alias("key")).union(found.rows.where(F.col("node").isNull()).select("row"))
    # Copies of a row go before the shuffle: there may be any number.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(id_column, text).alias("key")).dropDuplicates(["key"])
    return whole.join(sized(stay), "key", "left_semi").select("row.*")
