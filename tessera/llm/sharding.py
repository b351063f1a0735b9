"""Shards by sampled splitters: size-weighted key samples, quantile boundaries, range partition.

A record's key is (hash of its text, hash of its id, copy number), so equal texts lie side by
side and rows that repeat a text, or even an id and a text, can still be told apart: any range
can be subdivided. Keys are drawn with a chance in proportion to their size; quantiles of the
sample cut the key space into many ranges, one pass sums the bytes of each, and overfull
ranges are sampled again and subdivided. Shards then follow the running total of bytes in key
order, so that each shard's bytes differ from the mean by less than one record.

Law ``bytes``. The size of a record is its text's UTF-8 bytes plus one; null counts as empty.
Null ids hash to one value. Rows that repeat id and text are separate records. Other columns
are not read. An empty table gives an empty result. Sample and splitters have a bounded size:
``SAMPLES_PER_RANGE`` keys a range, and one range for each ``ROWS_PER_RANGE`` rows at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, narrow

SHARDS = 16
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 16
ROWS_PER_RANGE = 500_000
#: A range is overfull when it holds more than this many times its share of the bytes.
OVERFULL = 2.0
_KEY = "text_hash long, id_hash long, copy long"


def _key_bytes(text_hash, id_hash, copy) -> np.ndarray:
    """Keys as 24 bytes whose byte order is the order of the three signed numbers."""
    parts = np.stack([np.asarray(x, np.int64) for x in (text_hash, id_hash, copy)], 1)
    return ((parts.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8")).view("S24").ravel()


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, key columns): narrow, one row per input row, checkpointed."""
    rows = narrow(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"), F.xxhash64("doc_id").alias("id_hash"))
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
    return cut(counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n"))


def _sample(rows: DataFrame, per_byte: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys and weights of rows drawn with a chance of size * per_byte, by a hash of the key."""
    chance = F.col("size") * F.lit(per_byte)
    draw = F.pmod(F.xxhash64("id_hash", "text_hash", "copy", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.filter(draw < chance).select("text_hash", "id_hash", "copy", F.greatest(chance, F.lit(1.0)).alias("w")).toPandas()
    keys = _key_bytes(drawn["text_hash"], drawn["id_hash"], drawn["copy"]) if len(drawn) else np.empty(0, "S24")
    order = np.argsort(keys)
    return keys[order], drawn["w"].to_numpy(float)[order]


def _quantiles(keys: np.ndarray, weights: np.ndarray, parts: int) -> np.ndarray:
    if not len(keys) or parts < 2:
        return np.empty(0, "S24")
    running = np.cumsum(weights)
    return np.unique(keys[np.searchsorted(running, running[-1] * np.arange(1, parts) / parts).clip(0, len(keys) - 1)])


def _with_range(rows: DataFrame, splitters: np.ndarray) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = _key_bytes(*(b.column(c).to_numpy(zero_copy_only=False) for c in ("text_hash", "id_hash", "copy")))
            found = np.searchsorted(splitters, keys, side="right").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found)], names=[*b.schema.names, "range_id"])

    return rows.mapInArrow(place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", range_id long")


def find_splitters(rows: DataFrame, shards: int = SHARDS) -> np.ndarray:
    """Sorted splitter keys such that no range of more than one record is overfull."""
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(shards * RANGES_PER_SHARD, -(-n // ROWS_PER_RANGE))
    if n == 0:
        return np.empty(0, "S24")
    share = total / ranges
    splitters = _quantiles(*_sample(rows, SAMPLES_PER_RANGE / share), ranges)
    while True:
        placed = _with_range(rows, splitters)
        over = (placed.groupBy("range_id").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("size").alias("top"))
                .filter((F.col("bytes") - F.col("top") > share * OVERFULL) & (F.col("n") > 1)).select("range_id"))
        full = [r[0] for r in over.collect()]
        if not full:
            return splitters
        keys, weights = _sample(placed.join(F.broadcast(over), "range_id", "left_semi"), 4 * SAMPLES_PER_RANGE / share)
        at, more = np.searchsorted(splitters, keys, side="right"), []
        for r in full:
            mine = at == r
            more.append(_quantiles(keys[mine], weights[mine], max(2, int(weights[mine].sum() / (4 * SAMPLES_PER_RANGE)) + 1)))
        wider = np.unique(np.concatenate([splitters, *more]))
        if len(wider) == len(splitters):
            return splitters  # a range whose first key is all that the sample holds: one record
        splitters = wider


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, range_id, shard, slot): one row per input row.

    A record's shard follows the bytes before it in key order: those of earlier ranges (a sum
    per range) and, inside its range, a window over a bounded number of records.
    """
    rows = records(docs, id_col, text_col)
    placed = _with_range(rows, find_splitters(rows, shards))
    sums = placed.groupBy("range_id").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range_id").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = cut(sums.select("range_id", F.coalesce(F.sum("bytes").over(before), zero).alias("bytes_before"),
                             F.coalesce(F.sum("n").over(before), zero).alias("rows_before"),
                             F.sum("bytes").over(Window.partitionBy()).alias("total")))
    inside = Window.partitionBy("range_id").orderBy("text_hash", "id_hash", "copy", "doc_id")
    earlier = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), zero)
    ranked = (placed.withColumn("earlier", earlier).withColumn("nth", F.row_number().over(inside).cast("long") - 1)
              .join(F.broadcast(starts), "range_id")
              .withColumn("at", F.col("bytes_before") + F.col("earlier"))
              .withColumn("nth", F.col("rows_before") + F.col("nth"))
              .withColumn("shard", F.expr(f"cast((at * {shards}) div total as int)")))
    ranked = cut(ranked.select("doc_id", "size", "text_crc32", "range_id", "shard", "nth"))
    first = ranked.groupBy("shard").agg(F.min("nth").alias("first"))
    return (ranked.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "range_id", "shard", (F.col("nth") - F.col("first")).alias("slot")))
