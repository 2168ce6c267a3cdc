"""Benchmark decontamination: Wu-Manber search for windows of test items in whole documents.

The symbols are words. All windows of one length form a search: a block of two words that stands nowhere in a
window lets the scan jump over nearly a whole window, a block that may end one leads to a bucket of windows, and a
comparison word by word confirms. Windows have ten words; the only window of a shorter item goes to a search of its
own length, so that one short item does not shorten the jumps of all others.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shapelens.llm.texts import packed, slices, words_of
from shapelens.session import sized

#: Bytes of item text whose tables go to the executors at once; larger benchmarks are searched block by block.
BLOCK_BYTES = 4 << 20


class Search:
    """Wu-Manber tables over windows of one length."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], set[str]]):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.ending: dict = defaultdict(list)
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                block = window[end - self.block: end]
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            self.ending[window[length - self.block:]].append((list(window), sorted(items)))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """First word and items of every occurrence, from left to right."""
        shift, far, back, n = self.shift, self.far, self.block - 1, len(words)
        at = self.length - 1
        while at < n:
            block = (words[at - 1], words[at]) if back else (words[at],)
            jump = shift.get(block, far)
            if jump:
                at += jump
                continue
            start = at - self.length + 1
            here = words[start: at + 1]
            for window, items in self.ending[block]:
                if window == here:
                    yield start, items
            at += 1


def searches(items: list[tuple[str, str | None]], window: int) -> list[Search]:
    """Tables for all windows of some (item id, text)."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            by_length[size][tuple(words[i: i + size])].add(item)
    return [Search(size, windows) for size, windows in sorted(by_length.items(), reverse=True)]


def hits_of(words: list[bytes], tables: list[Search]) -> tuple[list[tuple[int, int]], set[str]]:
    """Disjoint word ranges inside occurrences, and the items whose windows occur."""
    found, items = [], set()
    for search in tables:
        for start, names in search.find(words):
            found.append((start, start + search.length))
            items.update(names)
    return merged(found), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")), F.col(text)).toLocalIterator(prefetchPartitions=True)
    for row in rows:
        block.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item: str = "item_id",
                       item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The `keep` columns of every document, with `n_words`, `hit_ranges` and `hit_items`.

    `hit_ranges` are disjoint ranges of word numbers (end exclusive) that stand inside an occurrence of a window,
    `hit_items` the sorted distinct ids (as strings; null is the empty string) of items with an occurrence. Documents
    are scanned where they are read: no shuffle. The benchmark reaches the executors in blocks of bounded size; with
    more than one block the documents and what has been found so far are written between blocks.

    Null and empty texts have no words and no hits; an empty benchmark hits nothing; items without words are never
    found; repeated documents and items are treated one by one; an empty table gives an empty table; other columns are
    left out unless named in `keep`.
    """
    fields = [T.StructField("n_words", T.LongType()), T.StructField("hit_ranges", T.ArrayType(T.ArrayType(T.LongType()))),
              T.StructField("hit_items", T.ArrayType(T.StringType()))]
    names = [f"c{i}" for i in range(len(keep))]
    kept = [T.StructField(n, docs.schema[k].dataType) for n, k in zip(names, keep, strict=True)]
    state = docs.select(*[F.col(k).alias(n) for n, k in zip(names, keep, strict=True)], F.col(text).alias("body"))
    ranges, ids = pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())

    def scan(tables: list[Search], first: bool):
        def run(batches):
            for part in slices(batches, "body", 4 << 20):
                words, spans, items = [], [], []
                old = [([], [])] * part.num_rows if first else list(zip(part.column("hit_ranges").to_pylist(), part.column("hit_items").to_pylist(), strict=True))
                for body, (span0, item0) in zip(part.column("body").to_pylist(), old, strict=True):
                    tokens = words_of(body)
                    span, found = hits_of(tokens, tables)
                    words.append(len(tokens))
                    spans.append(span if first else merged([*map(tuple, span0), *span]))
                    items.append(sorted({*item0, *found}))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), part.column("body"), pa.array(words, pa.int64()), pa.array(spans, ranges), pa.array(items, ids)],
                    names=[*names, "body", *(f.name for f in fields)])
        return run

    schema = T.StructType([*kept, T.StructField("body", T.StringType()), *fields])
    first = True
    for block in _blocks(benchmark, item, item_text, block_bytes):
        if not first:
            state = sized(state)
        state = state.mapInArrow(scan(searches(block, window), first), schema)
        first = False
    if first:
        state = state.mapInArrow(scan([], True), schema)
    return state.select(*[F.col(n).alias(k) for n, k in zip(names, keep, strict=True)], *(f.name for f in fields))


def n_hit() -> F.Column:
    """Number of words inside the ranges."""
    return F.aggregate("hit_ranges", F.lit(0).cast("long"), lambda total, r: total + r[1] - r[0])


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: counts of words, hit words and items, and a digest of the items."""
    found = find_contamination(docs, benchmark, ["doc_id"])
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.size("hit_ranges") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a word inside an occurrence; columns as they were."""
    return find_contamination(packed(docs), benchmark, ["row"]).where(F.size("hit_ranges") == 0).select("row.*")
