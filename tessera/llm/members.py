"""A filter of 64-bit keys that scans test in NumPy; its size follows from a count of the keys.

``key_filter`` holds two bits for each key in a bitmap of 64 bits a key or more, so that about one
foreign key in a thousand passes. At most ``2 ** MAX_BITS`` bits (16 MB) are made; a set of keys
too large for that gets no filter, and the caller's own join on the keys does all the work. The
filter never decides: every caller joins or counts what passes by the exact key.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import shuffles_removed

BITS_PER_KEY = 64
MIN_BITS = 20
MAX_BITS = 27
#: Below this many bits a key the filter would let too much through and isn't made.
LEAST_BITS_PER_KEY = 8
#: Bits of a row of Spark's bitmap aggregates.
_ROW = 32_768
_ODD = 0x9E3779B97F4A7C15


def _second(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(_ODD)) >> np.uint64(24)


def key_filter(keys: DataFrame, name: str, max_bits: int = MAX_BITS) -> np.ndarray | None:
    """The filter of the long column ``name`` of ``keys``, whose lineage should be cut; None: too many keys."""
    n = keys.count()
    if n * LEAST_BITS_PER_KEY > 1 << max_bits:
        return None
    bits = min(max(math.ceil(math.log2(max(n, 1) * BITS_PER_KEY)), min(MIN_BITS, max_bits)), max_bits)

    def places(rows):
        for batch in rows:
            import pyarrow as pa

            k = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            both = np.concatenate([k, _second(k)]) & np.uint64((1 << bits) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(both.astype(np.int64) + 1)], ["at"])

    out = np.zeros((1 << bits) // 8, np.uint8)
    with shuffles_removed(keys.sparkSession):
        found = (keys.select(name).mapInArrow(places, "at long")
                 .select(F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at").cast("int").alias("at"))
                 .repartition("bucket")  # a row per key is shuffled, not a bitmap per task
                 .groupBy("bucket").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits"))).collect()
    for r in found:
        at = (r["bucket"] - 1) * (_ROW // 8)
        out[at:at + _ROW // 8] |= np.frombuffer(r["bits"], np.uint8)
    return out


def holds(bits: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    """True for each key of the filter and for few others; all true without a filter."""
    if bits is None:
        return np.ones(len(keys), bool)
    mask = np.uint64(len(bits) * 8 - 1)
    first = keys & mask
    passed = (bits[first >> np.uint64(3)] >> (first & np.uint64(7)).astype(np.uint8)) & 1
    at = np.flatnonzero(passed)
    second = _second(keys[at]) & mask
    out = np.zeros(len(keys), bool)
    out[at] = (bits[second >> np.uint64(3)] >> (second & np.uint64(7)).astype(np.uint8)) & 1
    return out
