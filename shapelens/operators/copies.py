"""Byte-equal messages, found without shuffling every message.

Each message falls into one of a fixed number of cells by a hash of its bytes. A task keeps two bits per cell (one
message seen, more than one seen); the tables of all tasks add up to one that says which cells hold more than one
message. Messages alone in their cell have no copy and stay where they are. Only the others, which are the copies and
some that share a cell by chance, are compared by their digests. The table has the same size whatever the data's;
when there are far more messages than cells, most share one, and the comparison is that of all messages.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shapelens.session import sized

#: Cells of the table, and of one row of it.
CELL_BITS, ROW_BITS = 24, 15


def _tables(batches: Iterable[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    """What one task has seen: rows of the table with at least one message."""
    once, more = np.zeros(cells, bool), np.zeros(cells, bool)
    for batch in batches:
        at, n = np.unique(batch.column("cell").to_numpy(zero_copy_only=False), return_counts=True)
        more[at] |= once[at] | (n > 1)
        once[at] = True
    width = min(cells, 1 << ROW_BITS)
    for row in np.flatnonzero(once.reshape(-1, width).any(axis=1)):
        part = slice(row * width, (row + 1) * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row], pa.int64()), pa.array([np.packbits(once[part], bitorder="little").tobytes()], pa.binary()), pa.array([np.packbits(more[part], bitorder="little").tobytes()], pa.binary())],
            names=["row", "once", "more"])


def _added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the table over all tasks, which come in order; holds one row at a time."""
    row, once, more = None, None, None

    def words() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([more.view(np.int64).tolist()], pa.list_(pa.int64()))], names=["row", "words"])

    for batch in batches:
        for r, o, m in zip(batch.column("row").to_pylist(), batch.column("once").to_pylist(), batch.column("more").to_pylist()):
            o, m = np.frombuffer(o, np.uint8), np.frombuffer(m, np.uint8)
            if r != row:
                if row is not None and more.any():
                    yield words()
                row, once, more = r, o.copy(), m.copy()
            else:
                more |= m | (once & o)
                once |= o
    if row is not None and more.any():
        yield words()


def shared_cells(cells: DataFrame, bits: int = CELL_BITS) -> DataFrame:
    """`(row, words)`: bits of the cells in `(cell)` that hold more than one message; at most 2**bits / 8 bytes in all."""
    tables = cells.where("cell is not null").mapInArrow(lambda batches: _tables(batches, 1 << bits), "row bigint, once binary, more binary")
    return sized(tables.repartition("row").sortWithinPartitions("row").mapInArrow(_added, "row bigint, words array<bigint>"))


def cell_of(by: list[str], value: str = "value", bits: int = CELL_BITS) -> Column:
    """Cell of a message within `by`; null for a message without bytes, which is nobody's copy."""
    return F.when(F.col(value).isNotNull(), F.xxhash64(*by, value).bitwiseAND(F.lit((1 << bits) - 1)))


def in_shared_cell(rows: DataFrame, by: list[str], bits: int = CELL_BITS) -> DataFrame:
    """Rows with `_shared`: whether another message fell into the same cell. No row is shuffled."""
    row_bits = min(bits, ROW_BITS)
    table = shared_cells(rows.select(cell_of(by, bits=bits).alias("cell")), bits).withColumnRenamed("row", "_row")
    keyed = rows.withColumn("_cell", cell_of(by, bits=bits)).withColumn("_row", F.shiftright("_cell", row_bits))
    place = F.col("_cell").bitwiseAND(F.lit((1 << row_bits) - 1))
    bit = F.expr("getbit(get(words, cast(shiftright(_place, 6) as int)), cast(_place & 63 as int))")
    # the table's size is fixed by `bits`
    joined = keyed.join(F.broadcast(table), "_row", "left").withColumn("_place", place)
    return joined.withColumn("_shared", F.coalesce(bit == 1, F.lit(False))).select(*rows.columns, "_shared")
