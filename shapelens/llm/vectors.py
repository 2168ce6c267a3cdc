"""Vectors of integers out of columns of floating point lists, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1024
#: Up to this size of components, products and squared distances summed over 64 components stay below 2**53, so that
#: floating point gives them exactly. Beyond it integers of any size are used.
EXACT = float(1 << 22)
EXACT_DIMS = 64
#: Components that are unpacked at once.
SLICE = 1 << 21


def is_usable(vector: Column) -> Column:
    """Neither null nor with null or infinite components or NaN, also after scaling."""
    top = F.lit(float("inf"))
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < top))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def matrices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows with their vectors as floor(SCALE * x), in float64; shorter vectors of a slice are filled up with zeros."""
    for batch in batches:
        lengths = pc.list_value_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < len(lengths):
            widest = np.maximum.accumulate(np.maximum(lengths[at:], 1))
            fits = widest * np.arange(1, len(widest) + 1) <= SLICE
            to = at + max(1, int(fits.argmin()) if not fits.all() else len(fits))
            rows = batch.slice(at, to - at)
            flat = rows.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            here = lengths[at:to]
            out = np.zeros((len(here), int(here.max(initial=0))))
            out[np.arange(out.shape[1]) < here[:, None]] = np.floor(flat * SCALE)
            yield rows, out
            at = to


def exact(*arrays: np.ndarray) -> bool:
    """Whether floating point gives exact products and squared distances of these arrays' rows."""
    return all(a.shape[-1] <= EXACT_DIMS and (not a.size or np.abs(a).max() <= EXACT) for a in arrays)


def integers(array: np.ndarray) -> np.ndarray:
    """The same values as Python integers."""
    return np.array([int(x) for x in array.ravel()], dtype=object).reshape(array.shape)


def longs(values: Iterable[int]) -> pa.Array:
    """Integers as longs, null where they do not fit."""
    return pa.array([int(v) if -(1 << 63) <= v < 1 << 63 else None for v in values], pa.int64())
