"""Small helpers shared by the operators that work on Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LETTERS = bytes(range(65, 91))
#: Lower-cases A-Z and turns every byte outside of words into a space. Bytes from 0x80 on belong to words, so this
#: is the same on UTF-8 bytes as the class [^\x00-\x2F\x3A-\x60\x7B-\x7F] is on code points.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Lower-cases A-Z and nothing else.
LOWER_BYTES = bytes(b + 32 if b in _LETTERS else b for b in range(256))

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_33 = np.uint64(33)
_BASE = 0x9E3779B97F4A7C15


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words of a text as UTF-8 bytes; none for null."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of MurmurHash3, in place on a fresh array."""
    x ^= x >> _33
    x *= _MIX1
    x ^= x >> _33
    x *= _MIX2
    x ^= x >> _33
    return x


def part_of(key: Column, modulus: int, otherwise: int) -> Column:
    """crc32 of a key as text, modulo; `otherwise` for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(otherwise))


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice have at most `max_bytes`, or are a single one.

    Working arrays are a multiple of a slice, so this bounds the memory of a task.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < len(ends):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


class WordHashes:
    """64-bit hashes of the words of many texts at once, without a Python object per word."""

    def __init__(self, table: bytes = WORD_BYTES) -> None:
        """table: what each byte counts as; 32 separates words."""
        self.table = np.frombuffer(table, np.uint8)
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            n = 1 << (n - 1).bit_length()
            step = np.full(n - 1, _BASE, np.uint64)
            back = np.full(n - 1, pow(_BASE, -1, 1 << 64), np.uint64)
            self.powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(step)])
            self.inverse = np.concatenate([np.ones(1, np.uint64), np.cumprod(back)])

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word in order, and for each text the number of words before it (n + 1 entries)."""
        return self.spans(raw, offsets)[:2]

    def spans(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """The same, with the first byte and the end of every word."""
        if not len(raw):
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = self.table[raw]
        word = low != 32
        first = np.zeros(len(raw) + 1, bool)
        first[offsets[:-1]] = True
        before = np.empty(len(raw), bool)
        before[0] = False
        before[1:] = word[:-1]
        begins = np.flatnonzero(word & (~before | first[:-1]))
        after = np.empty(len(raw), bool)
        after[-1] = False
        after[:-1] = word[1:]
        first[len(raw)] = True
        ends = np.flatnonzero(word & (~after | first[1:])) + 1
        self._grow(len(raw) + 1)
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(low * self.powers[: len(raw)], out=total[1:])
        hashes = (total[ends] - total[begins]) * self.inverse[begins]
        hashes += (ends - begins).astype(np.uint64) << np.uint64(56)
        return mix(hashes), np.searchsorted(begins, offsets), begins, ends


def packed(docs: DataFrame, text: str = "text") -> DataFrame:
    """`row`, a struct of all columns, and `text`: results added to it can't clash with a column of the table."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("text"))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
