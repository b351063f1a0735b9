"""Keys and texts shuffled as sorted, compressed blocks: a row per block and bucket.

A task that has summed a million keys hands them on as the differences of neighbours, byte by byte of the
same rank, which takes a third or less of a row for each key. There are ``BUCKETS`` buckets for each
shuffle partition of the session, by ranges of hashed keys, so they are even whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Buckets for each shuffle partition.
BUCKETS = 4


def planes(x: np.ndarray) -> bytes:
    """64-bit numbers byte by byte of the same rank, so that the zeros lie together."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def numbers_of(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def shrink(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def grow(data: bytes, size: int) -> bytes:
    return pa.decompress(data, size, codec="zstd", asbytes=True)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(inverse, np.concatenate(counts), len(found)).astype(np.int64)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each bucket; a partition is sorted by bucket."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row["bucket"] != rows[0]["bucket"]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def dealt(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("bucket").sortWithinPartitions("bucket")


def n_buckets(df: DataFrame) -> int:
    return max(1, BUCKETS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def count_keys(rows: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], least: int,
               bits: int, keep: int = 1_000_000) -> DataFrame:
    """(key, n): keys of ``bits`` bits that occur ``least`` times or more in all.

    ``keys_of`` turns the rows' batches into arrays of unsigned keys, which should be hashes; a task
    sums up to ``keep`` and more of them before it hands them on.
    """
    buckets = n_buckets(rows)
    width = -(-(1 << bits) // buckets)

    def blocks(keys, counts):
        border = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) * np.uint64(width)).tolist()
        found = []
        for k, (low, high) in enumerate(zip(border, border[1:])):
            if low < high:
                steps = np.diff(keys[low:high], prepend=np.uint64(0))
                found.append((k, high - low, shrink(planes(steps) + planes(counts[low:high]))))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int32()), pa.array([r[1] for r in found], pa.int64()),
                                           pa.array([r[2] for r in found], pa.binary())], ["bucket", "size", "block"])

    def run(batches):
        keys, counts, size = [], [], 0
        for found in keys_of(batches):
            k, n = np.unique(found, return_counts=True)
            keys.append(k)
            counts.append(n)
            size += len(k)
            if size > 3 * keep:
                k, n = summed(keys, counts)
                keys, counts, size = [k], [n], len(k)
                if size > 2 * keep:
                    yield blocks(k, n)
                    keys, counts, size = [], [], 0
        if keys:
            yield blocks(*summed(keys, counts))

    def add(batches):
        for found in by_bucket(batches):
            halves = [(grow(r["block"], 16 * r["size"]), 8 * r["size"]) for r in found]
            k, n = summed([np.cumsum(numbers_of(x[:at]), dtype=np.uint64) for x, at in halves],
                          [numbers_of(x[at:]).astype(np.int64) for x, at in halves])
            kept = n >= least
            yield pa.RecordBatch.from_arrays([pa.array(k[kept].view(np.int64)), pa.array(n[kept])], ["key", "n"])

    return dealt(rows.mapInArrow(run, "bucket int, size long, block binary")).mapInArrow(add, "key long, n long")
