"""Shapes of JSON texts, counted over Arrow batches.

The shape of an event is its JSON text with a stand-in for every value that keeps the value's JSON type; it is JSON
itself. Texts without backslashes take a few passes of numpy over the bytes of a whole batch. Texts with escapes,
numbers of 19 or more digits and whatever else is odd take a tokenizer one by one. A batch gives one row per shape.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Marks of values inside a batch: control characters, which no JSON text holds; and the values that they become.
_TEXT, _INTEGER, _FRACTION, _TRUTH, _NULL = range(1, 6)
_VALUES = {_TEXT: '"s"', _INTEGER: "0", _FRACTION: "1.5", _TRUTH: "true", _NULL: "null"}

_WHITE = np.isin(np.arange(256), [9, 10, 13, 32])
_WORD = np.array([chr(c).isalnum() and c < 128 or chr(c) in "+-." for c in range(256)])
_BROKEN = np.isin(np.arange(256), [ord(c) for c in ".eE"])

_STRING = r'"(?:[^"\\]++|\\.)*+"'
_TOKENS = re.compile(
    rf'[ \t\n\r]++|(?:(?P<key>{_STRING}(?=[ \t\n\r]*+:))|(?P<text>{_STRING})|(?P<exponent>-?\d++(?:\.\d++)?[eE][+-]?\d++)'
    r"|(?P<long>-?(?=[\d.]{19})\d++(?:\.\d++)?)|(?P<fraction>-?\d++\.\d++)|(?P<integer>-?\d++)|(?P<truth>true|false)|(?P<null>null))", re.S | re.A)
_MARKS = {"text": _TEXT, "exponent": _FRACTION, "fraction": _FRACTION, "integer": _INTEGER, "truth": _TRUTH, "null": _NULL}
#: An item like the one before it changes neither types nor presence. No key holds a brace with a quote behind it.
_REPEATS = re.compile(r'([\[,])([\x01-\x05]|\{"[^{}\[\]]*+\})(?:,\2)++(?=[,\]])')


def _marked(text: str) -> str:
    """One text with marks in place of its values."""
    return _TOKENS.sub(lambda m: chr(_MARKS[m.lastgroup]) if m.lastgroup in _MARKS else (m[m.lastgroup] if m.lastgroup else ""), text)


def _shape(marked: str) -> str:
    return (_REPEATS.sub(r"\1\2", marked) if "[" in marked else marked).translate(_VALUES)


def _marked_plain(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Texts without backslashes, with even numbers of quotes, with marks; and for which of them that cannot be done here."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    size = len(raw)
    quotes = np.flatnonzero(raw == ord('"'))
    opens, closes = quotes[::2], quotes[1::2]
    padded = np.append(raw, np.uint8(0))
    inside = _between(opens, closes, size)
    word = _WORD[raw] & ~inside
    # a word ends with its text
    edges = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < size)]
    cut = np.unique(cut[word[cut] & word[cut - 1]]) if len(cut) else cut
    starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
    first = raw[starts]
    number = (first == ord("-")) | ((first >= ord("0")) & (first <= ord("9")))
    fraction = np.zeros(len(starts), bool)
    fraction[np.searchsorted(starts, np.flatnonzero(_BROKEN[raw] & word), "right") - 1] = True
    marks = np.select([number & fraction, number, (first == ord("t")) | (first == ord("f")), first == ord("n")], [_FRACTION, _INTEGER, _TRUTH, _NULL], 0)
    odd = (marks == 0) | (number & (ends - starts - (first == ord("-")) >= 19))
    after = closes + 1
    while (blank := _WHITE[padded[np.minimum(after, size)]]).any():
        after = after + blank
    value = padded[np.minimum(after, size)] != ord(":")
    keep = (inside | ~_WHITE[raw]) & ~word & ~_between(opens[value], closes[value], size)
    keep[starts], keep[opens[value]] = True, True
    out = raw.copy()
    out[starts], out[opens[value]] = marks, _TEXT
    places = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32)
    left = np.zeros(n, bool)
    left[np.searchsorted(offsets, starts[odd], "right") - 1] = True
    return pa.StringArray.from_buffers(n, pa.py_buffer(places.tobytes()), pa.py_buffer(out[keep].tobytes())), left


def _between(opens: np.ndarray, closes: np.ndarray, size: int) -> np.ndarray:
    """Whether each byte lies between an opening and its closing, both included."""
    step = np.zeros(size + 1, np.int8)
    step[opens] += 1
    step[closes + 1] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).view(bool)


def marked_texts(column: pa.Array) -> pa.Array:
    """Texts, none of them null, with marks in place of values."""
    column = column.cast(pa.string())
    plain = pc.and_(pc.invert(pc.match_substring(column, "\\")), pc.equal(pc.bit_wise_and(pc.count_substring(column, '"'), 1), 0)).to_numpy(zero_copy_only=False)
    out, left = _marked_plain(column if plain.all() else column.filter(pa.array(plain)))
    if plain.all() and not left.any():
        return out
    one_by_one = ~plain
    one_by_one[np.flatnonzero(plain)[left]] = True
    by_hand = pa.array([_marked(t) for t in column.filter(pa.array(one_by_one)).to_pylist()], pa.string())
    both = pa.concat_arrays([out.filter(pa.array(~left)), by_hand])
    order = np.empty(len(column), np.int64)
    order[np.concatenate([np.flatnonzero(~one_by_one), np.flatnonzero(one_by_one)])] = np.arange(len(column))
    return both.take(pa.array(order))


def counted(keys: list[str]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For `mapInArrow` over `(keys, shape)`, where `shape` still is the text: `(keys, shape, n)` of each batch, without null texts."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.filter(pc.is_valid(table.column("shape"))).combine_chunks()
            if not len(table):
                continue
            texts = table.column("shape").combine_chunks()
            texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
            found = table.select(keys).append_column("shape", marked_texts(texts)).group_by([*keys, "shape"]).aggregate([([], "count_all")])
            shapes = pa.array([_shape(m) for m in found.column("shape").to_pylist()], pa.string())
            made = pa.table({**{k: found.column(k) for k in keys}, "shape": shapes, "n": found.column("count_all").cast(pa.int64())})
            yield from made.to_batches()

    return count
