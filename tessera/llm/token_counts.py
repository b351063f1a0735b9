"""Token counts from an exact histogram of encoded lengths.

Documents are counted by encoded length, with counts summed in each task before the shuffle.
Suffix sums over the lengths then answer totals, quantiles and truncated totals for every
context limit without reading the documents again. Suffix sums are taken in two steps, inside
blocks of lengths and over the blocks' totals, so no task holds all lengths.

Null texts count as empty (length 0). Rows that repeat are counted each. Other columns are not
read. An empty table gives an empty histogram.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut, slices, texts
from tessera.llm.tokens import byte_bpe

#: Lengths in a block of the two-step suffix sums.
BLOCK = 4096


def length_counts(docs: DataFrame, text_col: str = "text", tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """(length, n_docs): the histogram, checkpointed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, found = byte_bpe(tokenizer), Counter()
        for batch in slices(batches):
            found.update(len(bpe.ids(t)) // 4 for t in texts(batch))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["length", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "length long, n long")
    return cut(rows.groupBy("length").agg(F.sum("n").alias("n_docs")))


def histogram(counts: DataFrame) -> DataFrame:
    """A row per length: its documents and tokens, and the sums over this length and longer ones.

    ``truncated_tokens`` is the corpus' tokens when each document is cut at this length;
    ``docs_at_most`` ranks the length for quantiles.
    """
    zero = F.lit(0).cast("long")
    rows = counts.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.expr(f"length div {BLOCK}"))
    later = Window.partitionBy("block").orderBy(F.col("length").desc())
    rows = rows.select("*", F.sum("n_docs").over(later).alias("docs_here"), F.sum("n_tokens").over(later).alias("tokens_here"))
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("d").over(after), zero).alias("docs_after"), F.coalesce(F.sum("t").over(after), zero).alias("tokens_after"),
                           F.sum("d").over(Window.partitionBy()).alias("all_docs"), F.sum("t").over(Window.partitionBy()).alias("all_tokens"))
    rows = rows.join(blocks, "block").select("*", (F.col("docs_here") + F.col("docs_after")).alias("docs_at_least"),
                                             (F.col("tokens_here") + F.col("tokens_after")).alias("tokens_at_least"))
    return rows.select("length", "n_docs", "n_tokens", "docs_at_least", "tokens_at_least",
                       (F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
                       (F.col("all_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"))


def totals(hist: DataFrame, limit: int) -> DataFrame:
    """(n_docs, n_tokens, truncated_tokens, n_over): the corpus under a context limit."""
    keep = F.least(F.col("length"), F.lit(limit).cast("long"))
    zero = F.lit(0).cast("long")
    return hist.agg(F.coalesce(F.sum("n_docs"), zero).alias("n_docs"), F.coalesce(F.sum("n_tokens"), zero).alias("n_tokens"),
                    F.coalesce(F.sum(keep * F.col("n_docs")), zero).alias("truncated_tokens"),
                    F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("n_docs"))), zero).alias("n_over"))


def quantile(hist: DataFrame, q: float) -> DataFrame:
    """(length): the smallest length that at least the part ``q`` of the documents don't exceed."""
    enough = F.col("docs_at_most") >= F.lit(q) * (F.col("docs_at_most") + F.col("docs_at_least") - F.col("n_docs"))
    return hist.filter(enough).agg(F.min("length").alias("length"))
