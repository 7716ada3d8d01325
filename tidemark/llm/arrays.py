"""Texts as byte arrays: shared helpers of the operators that work on Arrow batches.

A text column reaches Python as ``binary`` (its UTF-8 bytes). Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
_CHUNK = 256 << 10
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}

ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LOWER_TABLE = np.frombuffer(ASCII_LOWER, np.uint8)


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """Truth table of 256 bytes: those inside the given closed ``spans``."""
    table = np.zeros(256, bool)
    for first, last in spans:
        table[first : last + 1] = True
    return table


#: ``[^\x20\x09-\x0D]``: every byte that is no ASCII white space.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``: digits, lower-case ASCII letters and all bytes of other characters.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def utf8(text: str | Column) -> Column:
    """The text column as the bytes that the Arrow functions take."""
    return (F.col(text) if isinstance(text, str) else text).cast("binary")


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches end at :data:`BATCH_BYTES`, not only at a number of rows, unless the session says otherwise."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(2**31 - 1))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column and the ``n + 1`` row offsets in them."""
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if buffers[2] is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def row_blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes: first row, last row + 1, bytes, offsets. A longer row is a run of its own."""
    data, offsets = raw_bytes(column)
    row, rows = 0, len(column)
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER_TABLE[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes in the class ``inside``; no run crosses a row's bounds."""
    mask = inside[data]
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    before = np.empty(len(mask), bool)
    before[0] = False
    before[1:] = mask[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(mask))]
    before[cuts] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.empty(len(mask), bool)
    after[-1] = False
    after[:-1] = mask[1:]
    after[cuts - 1] = False
    return starts, np.flatnonzero(mask & ~after) + 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, _CHUNK + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each span's bytes. Works in chunks, so temporary arrays stay small."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + _CHUNK, "right")))
        length = int(ends[last - 1] - base)
        up, down = _powers(length + 1)
        sums = np.zeros(length + 1, np.uint64)
        np.cumsum((data[base : base + length].astype(np.uint64) + np.uint64(1)) * up[:length], out=sums[1:])
        low = starts[first:last] - base
        out[first:last] = (sums[ends[first:last] - base] - sums[low]) * down[low]
        first = last
    return mix(out)


def rows_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row of each byte position."""
    return np.searchsorted(offsets, positions, "right") - 1


def per_row(rows: np.ndarray, count: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sums by row as 64-bit integers."""
    if weights is None:
        return np.bincount(rows, minlength=count).astype(np.int64)
    out = np.zeros(count, np.int64)
    np.add.at(out, rows, weights)
    return out
