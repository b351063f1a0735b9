"""Packing by power-of-two decomposition: documents are cut into pieces of binary lengths.

A document's ids, with a closing id, are cut into as many pieces of ``max_len`` as fit and one
piece for each binary digit of the rest, longest first. Each piece is a sequence of its own
whose length is a power of two, so sequences need no padding and never cross documents; equal
lengths form a bucket that can be batched without masks. Sequences are numbered bucket by
bucket, longest first, and gapless.

Null texts count as empty: one piece with the closing id only. Null ids pass through, rows
that repeat an id are packed each on its own, other columns are not read, an empty table gives
an empty result. A task holds the ids of one document at a time.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, id_type, narrow, slices, texts
from tessera.llm.tokens import byte_bpe

MAX_LEN = 1024
END = 0


def piece_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Lengths of the pieces of ``n`` ids, in document order; ``max_len`` is a power of two."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in range(max_len.bit_length() - 2, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
           tokenizer: str = "byte_bpe_50k", end_id: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, part, nth[, ids]): a row per piece.

    ``nth`` counts the pieces of a length within the task ``part``; checkpointed, so that both
    stay as they are.
    """
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, end = TaskContext.get().partitionId(), Counter(), np.array([end_id], "<u4").tobytes()
        bpe = byte_bpe(tokenizer)
        for batch in slices(batches):
            row, out, cut_ids = [], [], []
            for i, text in enumerate(texts(batch)):
                ids = bpe.ids(text) + end
                at, total = 0, len(ids) // 4
                for n in piece_lengths(total, max_len):
                    piece = ids[4 * at:4 * (at + n)]
                    row.append(i)
                    out.append((at, n, zlib.crc32(piece), total, part, seen[n]))
                    if with_ids:
                        cut_ids.append(np.frombuffer(piece, "<u4").astype(np.int32))
                    seen[n] += 1
                    at += n
            columns = [batch.column("doc_id").take(pa.array(row, pa.int32())), *map(pa.array, zip(*out, strict=True))] if out else []
            if columns:
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
                if with_ids:
                    columns.append(pa.array(cut_ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (f"doc_id {id_type(docs, id_col)}, start long, length long, ids_crc32 long, doc_tokens long, part long, nth long"
              + ", ids array<int>" * with_ids)
    return cut(narrow(docs, id_col, text_col).mapInArrow(split, schema))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         tokenizer: str = "byte_bpe_50k", end_id: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])."""
    found = pieces(docs, id_col, text_col, max_len, tokenizer, end_id, with_ids)
    # one row per task and length: the number of pieces before it in its bucket, and before its bucket
    counts = found.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    longer = Window.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy("length").agg(F.sum("n").alias("n"))
    buckets = buckets.select("length", F.coalesce(F.sum("n").over(longer), zero).alias("bucket_start"))
    starts = (counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), zero).alias("task_start"))
              .join(buckets, "length").select("length", "part", (F.col("bucket_start") + F.col("task_start")).alias("base")))
    return (found.join(starts, ["length", "part"])
            .withColumn("sequence_id", F.col("base") + F.col("nth")).withColumn("offset", zero)
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])))
