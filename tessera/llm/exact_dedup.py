"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each step keeps only rows whose key so far was seen at least twice. The surviving keys of a
step are held as a bitmap of ``2 ** bits`` positions, so what is broadcast has a fixed size
whatever the data; two keys that share a position only let a row through to the next, stricter
step, and the full hash decides. No text is shuffled to find the groups: the keys of the first
two steps are counted with map-side aggregation, and the full hash is computed in the scan,
for surviving rows only. A group of copies that holds a third of all rows costs one aggregated
row per task.

Texts are equal when they are identical after each run of ASCII white space is replaced by one
space. Null texts count as empty. The row with the smallest id stays; null ids sort last, and
a group of null ids only has a null ``keep_id``. Of rows that repeat both id and text, one
stays. Other columns of the input are not read by ``exact_groups`` and pass unchanged through
``drop_exact_duplicates``; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, narrow

#: Runs of white space that are not already one space.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: Bits of a survivors' bitmap: 2 MB at 24.
BITS = 24
#: Characters of normalised text in the prefix hash.
PREFIX = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def full_hash(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _position(bits: int, *key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << bits))


def _seen_twice(positions: DataFrame, name: str) -> DataFrame:
    """Bitmap of the positions seen at least twice: rows (bucket, bitmap of 32,768 bits)."""
    twice = positions.groupBy(name).count().filter("count > 1")
    return (twice.groupBy(F.bitmap_bucket_number(name).alias(f"{name}_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(name))).alias(f"{name}_bits")))


def _only_seen_twice(rows: DataFrame, name: str, bitmap: DataFrame) -> DataFrame:
    """``rows`` with a boolean ``{name}_twice``; the broadcast bitmap has 2 ** bits / 8 bytes at most."""
    at = f"bitmap_bit_position({name})"
    byte = f"conv(hex(substring({name}_bits, cast({at} div 8 as int) + 1, 1)), 16, 10)"
    is_set = F.expr(f"(shiftright(cast({byte} as int), cast({at} % 8 as int)) & 1) = 1")
    return (rows.withColumn(f"{name}_bucket", F.bitmap_bucket_number(name))
            .join(F.broadcast(bitmap), f"{name}_bucket", "left")
            .withColumn(f"{name}_twice", F.coalesce(is_set, F.lit(False)))
            .drop(f"{name}_bucket", f"{name}_bits"))


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
           digest: bool = False) -> DataFrame:
    """(doc_id, full_hash, survivor): one row per input row.

    ``survivor`` is false for rows whose length or prefix no other row shares; their
    ``full_hash`` is null unless ``digest`` asks for it. The result is narrow and checkpointed.
    """
    norm = narrow(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("norm"))
    keyed = norm.select(
        "doc_id", "norm",
        _position(bits, F.length("norm")).alias("by_length"),
        _position(bits, F.length("norm"), F.substring("norm", 1, PREFIX)).alias("by_prefix"))
    lengths = cut(_seen_twice(keyed.select("by_length"), "by_length"))
    same_length = _only_seen_twice(keyed, "by_length", lengths)
    prefixes = cut(_seen_twice(same_length.filter("by_length_twice").select("by_prefix"), "by_prefix"))
    both = _only_seen_twice(same_length, "by_prefix", prefixes)
    survivor = F.col("by_length_twice") & F.col("by_prefix_twice")
    hashed = full_hash(F.col("norm")) if digest else F.when(survivor, full_hash(F.col("norm")))
    return cut(both.select("doc_id", hashed.alias("full_hash"), survivor.alias("survivor")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
                 digest: bool = False) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, full_hash): one row per input row."""
    rows = refine(docs, id_col, text_col, bits, digest)
    survivors = rows.filter("survivor")
    # written before it is joined back, so that Spark can split the join's side with the copies
    groups = cut(survivors.groupBy("full_hash")
                 .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                 .filter("group_size > 1"))
    # rows that repeat id and text are one key with a count, so that just one of them stays
    keys = survivors.groupBy("full_hash", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    in_groups = (keys.join(groups, "full_hash", "left")
                 .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
                 .select("doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
                         F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                         (F.col("doc_id").eqNullSafe(F.coalesce("keep_id", "doc_id"))
                          & (F.col("copy") == 1)).alias("kept"),
                         "full_hash"))
    alone = rows.filter("not survivor").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "full_hash")
    return alone.unionByName(in_groups)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          bits: int = BITS) -> DataFrame:
    """The input rows that stay, with all their columns.

    Only members of groups are looked up again, by (full hash, id), so the copies of a hot
    text spread over the ids instead of meeting in one task.
    """
    dropped = cut(exact_groups(docs, id_col, text_col, bits)
                  .filter("not kept").select(F.col("doc_id").alias("_xd_id"), F.col("full_hash").alias("_xd_hash"),
                                             F.col("keep_id").alias("_xd_keep")))
    tagged = docs.withColumn("_xd_hash", full_hash(normalised(F.col(text_col).cast("string"))))
    others = dropped.filter(~F.col("_xd_id").eqNullSafe(F.col("_xd_keep"))).select("_xd_id", "_xd_hash").distinct()
    same = (F.col(id_col).eqNullSafe(others["_xd_id"])) & (tagged["_xd_hash"] == others["_xd_hash"])
    left = tagged.join(others, same, "left_anti")
    repeated = dropped.filter(F.col("_xd_id").eqNullSafe(F.col("_xd_keep"))).select("_xd_id", "_xd_hash").distinct()
    if repeated.isEmpty():
        return left.drop("_xd_hash")
    again = (F.col(id_col).eqNullSafe(repeated["_xd_id"])) & (left["_xd_hash"] == repeated["_xd_hash"])
    once = left.join(repeated, again, "left_anti")
    twice = left.join(repeated, again, "left_semi").dropDuplicates([id_col, "_xd_hash"])
    return once.unionByName(twice).drop("_xd_hash")
