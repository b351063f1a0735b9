"""Global numbering without funnelling rows through one task.

``dense_index`` is the DataFrame form of zipWithIndex: a range-partitioned sort, one small
job that counts rows per partition, and a broadcast of those offsets. The offsets table has
one row per partition - bounded by the partition count, not the data - so it is computed
once, eagerly, and joined as a small local table wherever the index is read.
Range partitioning splits a hot key over several partitions, so a key holding a third of
all rows does not land in one task. The sorted data is checkpointed to the session's
reliable checkpoint folder so the counts and the numbering see the same partitions and a
lost executor does not recompute the sort with different boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir


def dense_index_counted(df: DataFrame, order_cols: list, name: str = "idx") -> tuple[DataFrame, int]:
    """``dense_index`` and the number of rows, known from the per-partition counts."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    s = (df.orderBy(*order_cols)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    counts = sorted((int(r["_pid"]), int(r["_n"]))
                    for r in s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect())
    rows, total = [], 0
    for pid, n in counts:
        rows.append((pid, total))
        total += n
    offsets = spark.createDataFrame(rows, "_pid int, _off bigint")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = (s.join(F.broadcast(offsets), "_pid")
           .withColumn(name, F.col("_off") + local)
           .drop("_pid", "_mid", "_off"))
    return out, total


def dense_index(df: DataFrame, order_cols: list, name: str = "idx") -> DataFrame:
    """Add ``name`` = 0-based position of each row in the order of ``order_cols``.

    ``order_cols`` should identify rows uniquely for a deterministic result.
    """
    return dense_index_counted(df, order_cols, name)[0]


def _ranked(key: str):
    """Per partition sorted by ``key``: each row's rank inside its key, as far as this partition knows.

    Adds ``_rank``, ``_head`` (the key is the partition's first) and ``_edge`` (first or last row).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, so_far, groups, waiting = None, 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            k = batch.column(key)
            one, two = k.slice(1), k.slice(0, n - 1)
            equal = pc.if_else(pc.and_(pc.is_null(one), pc.is_null(two)), True, pc.fill_null(pc.equal(one, two), False))
            same = np.r_[groups > 0 and k[0].as_py() == before, equal.to_numpy(zero_copy_only=False)].astype(bool)
            starts, at = np.flatnonzero(~same), np.arange(n)
            group = np.searchsorted(starts, at, "right")  # 0: goes on with the key of the batch before
            rank = np.where(group > 0, at - np.r_[0, starts][group], so_far + at)
            head = groups + group == 1
            edge = np.zeros(n, bool)
            edge[0] = groups == 0
            before, so_far, groups = k[n - 1].as_py(), int(rank[-1]) + 1, groups + len(starts)
            if waiting is not None:
                yield pa.RecordBatch.from_arrays([*waiting[0].columns, *map(pa.array, waiting[1:])], names)
            names = [*batch.schema.names, "_rank", "_head", "_edge"]
            waiting = (batch, rank, head, edge)
        if waiting is not None:
            waiting[3][-1] = True
            yield pa.RecordBatch.from_arrays([*waiting[0].columns, *map(pa.array, waiting[1:])], names)
    return run


def _carries(edges: list) -> list[tuple[int, int]]:
    """(partition, rows of its first key in the partitions before it), where there are any."""
    out, key, rows = [], None, 0
    for pid, (first, last) in sorted(edges):
        carry = rows if rows and first["k"] == key else 0
        if carry:
            out.append((pid, carry))
        key, rows = last["k"], last["_rank"] + 1 + (carry if last["_head"] else 0)
    return out


def rank_within(df: DataFrame, key: str, order_cols: list, name: str = "ordinal") -> DataFrame:
    """0-based rank of each row inside its ``key`` group, by ``order_cols``.

    Equal to ``row_number() over (partition by key order by ...) - 1`` as a segmented prefix scan: a
    range-partitioned sort, a rank inside each sorted partition, and for a key that spans
    partitions a carry from those before. The carries come from two rows of each partition, the first
    and the last, so a key of any size is spread over tasks and nothing is shuffled by the key alone.
    The sorted rows are checkpointed, so that ranks and carries see the same partitions.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    schema = T.StructType([*df.schema.fields, T.StructField("_rank", T.LongType()), T.StructField("_head", T.BooleanType()),
                           T.StructField("_edge", T.BooleanType())])
    ranked = (df.orderBy(key, *order_cols).mapInArrow(_ranked(key), schema)
              .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    found: dict[int, list] = {}
    for r in ranked.filter("_edge").select("_pid", F.col(key).alias("k"), "_rank", "_head").collect():
        found.setdefault(r["_pid"], []).append(r)
    edges = [(pid, (min(rows, key=_first), max(rows, key=_first))) for pid, rows in found.items()]
    carries = spark.createDataFrame(_carries(edges), "_pid int, _carry bigint")
    rank = F.col("_rank") + F.when(F.col("_head"), F.coalesce("_carry", F.lit(0))).otherwise(F.lit(0))
    return (ranked.join(F.broadcast(carries), "_pid", "left").withColumn(name, rank)  # a row per partition at most
            .drop("_pid", "_rank", "_head", "_edge", "_carry"))


def _first(edge) -> tuple:
    """Orders the two rows of a partition: the first one has its first key and rank 0."""
    return (not edge["_head"], edge["_rank"])
