"""A Bloom filter over keys: rows that cannot have a key are told apart where they are read, without a shuffle.

The filter is built by tasks as bitmaps and has a bounded size. With more keys than it is made for, more rows pass by mistake and take
the exact way; what comes out never changes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Bits per key, and how many of them a key sets; one row in four hundred passes by mistake.
BITS_PER_KEY, PROBES = 12, 3
FILTER_BYTES = 64 * 1024 * 1024
_BUCKET_BITS = 1 << 15


def _probes(columns: list[str], bits: int) -> list[Column]:
    return [F.xxhash64(F.lit(k), *columns).bitwiseAND(F.lit(bits - 1)) for k in range(PROBES)]


class KeyFilter:
    """Tests rows for membership in a set of keys; may say yes wrongly, never no."""

    def __init__(self, keys: DataFrame, columns: list[str], max_bytes: int = FILTER_BYTES):
        """Two small jobs over ``keys``: a count, and the bitmaps, of which at most ``max_bytes`` reach the driver."""
        self.columns = columns
        wanted = max(1, keys.count()) * BITS_PER_KEY
        self.bits = min(1 << math.ceil(math.log2(max(wanted, _BUCKET_BITS))), max(_BUCKET_BITS, 1 << int(math.log2(max_bytes * 8))))
        places = keys.select(F.explode(F.array(*_probes(columns, self.bits))).alias("place"))
        bitmaps = places.groupBy(F.shiftright("place", 15).alias("bucket")).agg(
            F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(_BUCKET_BITS - 1))).alias("bitmap")
        )
        content = bytearray(self.bits // 8)
        for row in bitmaps.collect():
            start = row["bucket"] * _BUCKET_BITS // 8
            content[start : start + len(row["bitmap"])] = row["bitmap"]
        self._shared = keys.sparkSession.sparkContext.broadcast(bytes(content))

    def maybe(self) -> Column:
        """False for rows whose key is certainly not in the set."""
        shared = self._shared

        # nested, so that it travels to the executors by value
        def test(first: pa.Array, second: pa.Array, third: pa.Array) -> pa.Array:
            bitmap = np.frombuffer(shared.value, np.uint8)
            found = np.ones(len(first), bool)
            for column in (first, second, third):
                place = column.to_numpy(zero_copy_only=False)
                found &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            return pa.array(found)

        return F.arrow_udf(test, returnType=T.BooleanType())(*_probes(self.columns, self.bits))
