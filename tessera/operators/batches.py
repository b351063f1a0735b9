"""Caption grouping, corpus sizes, seeded training batches (pad, shift, attach vectors).

The reference draws batches from an endless generator; here an epoch is a bounded,
replayable table: ``steps * batch_size`` draws, each a seeded hash, so the same seed gives
the same rows on any partitioning and after any retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators.indexing import dense_index_counted, rank_within
from tessera.operators.split import seeded_hash
from tessera.session import ensure_checkpoint_dir

#: Captions of a row of ``group_captions``.
PAGE_ROWS = 1000


def group_captions(df: DataFrame, key: str = "key", order: str = "caption_no",
                   text: str = "caption", page_rows: int = PAGE_ROWS) -> DataFrame:
    """(key, page, first, captions array<string>): the captions of a key in order, in pages.

    The nested shape of the reference, with a bound: a row holds at most ``page_rows`` captions, page
    ``p`` those from rank ``p * page_rows`` (``first``) on. Keys of one page, found by a count, are collected
    as they are; the captions of larger keys are ranked by a segmented scan first, so that their pages
    are spread over tasks.
    """
    rows = df.select(F.col(key).alias("k"), F.col(order).alias("o"), F.col(text).alias("t"))
    ensure_checkpoint_dir(df.sparkSession)
    large = rows.groupBy("k").count().filter(F.col("count") > page_rows).select("k").checkpoint(eager=True)
    small, paged = rows.withColumn("r", F.lit(None).cast("long")), None
    if not large.isEmpty():
        # a right side of a key and its mark: its rows are the keys of more than page_rows captions
        marked = rows.join(large.withColumn("m", F.lit(True)), rows["k"].eqNullSafe(large["k"]), "left").select(rows["*"], "m")
        small = marked.filter("m IS NULL").drop("m").withColumn("r", F.lit(None).cast("long"))
        paged = rank_within(marked.filter("m").drop("m"), "k", ["o", "t"], "r")
    rows = small if paged is None else small.unionByName(paged)
    page = F.coalesce(F.floor(F.col("r") / page_rows), F.lit(0)).cast("long")
    listed = F.array_sort(F.collect_list(F.struct(F.coalesce("r", F.lit(0)).alias("r"), "o", "t")))
    return (rows.groupBy("k", page.alias("page")).agg(listed.alias("x"))
            .select(F.col("k").alias(key), "page", (F.col("page") * page_rows).alias("first"),
                    F.transform("x", lambda s: s["t"]).alias("captions")))


def flatten_captions(grouped: DataFrame, key: str = "key", captions: str = "captions") -> DataFrame:
    """Inverse of group_captions: (key, caption_no, caption), order kept as a column, over all pages."""
    first = F.col("first") if "first" in grouped.columns else F.lit(0).cast("long")
    return grouped.select(key, first.alias("_first"), F.posexplode(captions).alias("caption_no", "caption")) \
        .select(key, (F.col("_first") + F.col("caption_no")).cast("bigint").alias("caption_no"), "caption")


def captions_per_key(df: DataFrame, key: str = "key") -> DataFrame:
    """(key, n): number of captions of each key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def corpus_size(df: DataFrame, by: str | None = "split", key: str = "key") -> DataFrame:
    """Captions and distinct keys, per split when ``by`` is given."""
    aggs = [F.count(F.lit(1)).alias("n_captions"), F.count_distinct(key).alias("n_keys")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def steps_per_epoch(df: DataFrame, batch_size: int = 384) -> DataFrame:
    """One row: ``floor(captions / batch_size)`` (truncating, as the reference does)."""
    return df.agg(F.floor(F.count(F.lit(1)) / F.lit(batch_size)).cast("bigint").alias("steps"))


def batch_max_length(batches: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(batch_id, max_len): longest token list in each batch."""
    return batches.groupBy("batch_id").agg(F.max(F.size(tokens)).alias("max_len"))


def random_caption(df: DataFrame, seed: int, key: str = "key", order: str = "caption_no") -> DataFrame:
    """One uniformly chosen caption per key: the row with the smallest hash(seed, key, no).

    The least hash of a key is a hash aggregation of longs with map-side sums; the row is fetched by
    (key, hash), so the captions of a hot key are neither sorted nor gathered. Of rows that repeat key
    and number one stays, that with the smallest hash of its other columns.
    """
    others = [c for c in df.columns if c not in (key, order)]
    rows = df.withColumn("_h", seeded_hash(seed, F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(order).cast("string"), F.lit(""))))
    for least in ("_h", "_t"):
        best = rows.groupBy(F.col(key).alias("_k")).agg(F.min(least).alias("_best"))
        rows = rows.join(best, rows[key].eqNullSafe(best["_k"]) & (rows[least] == best["_best"]), "left_semi")
        rows = rows.withColumn("_t", F.xxhash64(*others) if others else F.lit(0).cast("long"))
    return rows.select(key, order, *others).distinct()


def attach_features(rows: DataFrame, features: DataFrame, key: str = "key") -> DataFrame:
    """Inner equi join on key. Call it last, after rows are chosen: vectors are wide."""
    return rows.join(features, key)


def index_captions(encoded: DataFrame, key: str = "key", order: str = "caption_no"):
    """(captions with a global 0-based ``gidx``, keys with ``kidx``, first gidx and count,
    number of captions, number of keys)."""
    cap, n_captions = dense_index_counted(encoded, [key, order], "gidx")
    per_key = cap.groupBy(key).agg(F.min("gidx").alias("first"), F.count(F.lit(1)).alias("n"))
    keys, n_keys = dense_index_counted(per_key, [key], "kidx")
    return cap, keys, n_captions, n_keys


def draw_batches(encoded: DataFrame, features: DataFrame | None = None, batch_size: int = 384,
                 steps: int | None = None, seed: int = 1, epoch: int = 0,
                 key: str = "key", order: str = "caption_no", tokens: str = "tokens") -> DataFrame:
    """One epoch of training batches.

    Draw ``i`` (0 .. steps*batch_size-1) picks a key uniformly with replacement, then one of
    its captions uniformly - as the reference's generator does - both by seeded hash. Rows
    are chosen by two equi joins on unique indexes (no skew even when one key owns a third
    of the captions), padded to the batch maximum, shifted into input/target, and joined to
    their vector last.

    Output: batch_id, slot, key, caption_no, x array<int>, y array<int>[, features].
    """
    # only the identity of a caption is sorted and numbered; its tokens join the chosen rows
    cap, keys, n_captions, n_keys = index_captions(encoded.select(key, order), key, order)
    if steps is None:
        steps = n_captions // batch_size
    # zero steps (fewer captions than one batch) is an empty epoch, as truncation gives
    total = int(steps) * int(batch_size) if n_keys else 0
    n_keys = max(n_keys, 1)
    s = f"{seed}:{epoch}"
    draws = (cap.sparkSession.range(total).withColumnRenamed("id", "draw")
             .withColumn("batch_id", F.floor(F.col("draw") / batch_size).cast("bigint"))
             .withColumn("slot", (F.col("draw") % batch_size).cast("int"))
             .withColumn("kidx", seeded_hash(s + ":k", "draw") % F.lit(n_keys)))
    picked = (draws.join(keys.select("kidx", "first", "n"), "kidx")
              .withColumn("gidx", F.col("first") + seeded_hash(s + ":c", "draw") % F.col("n"))
              .join(cap.select("gidx", key, order), "gidx")
              .join(encoded.select(key, order, tokens), [key, order]))
    m = F.max(F.size(tokens)).over(Window.partitionBy("batch_id"))
    out = (picked.withColumn("_m", m)
           .withColumn("_p", T.pad_post(tokens, F.col("_m")))
           .select("batch_id", "slot", key, order,
                   T.shift_input("_p", F.col("_m")).alias("x"),
                   T.shift_target("_p", F.col("_m")).alias("y")))
    if features is not None:
        out = attach_features(out, features, key)
    return out.select("batch_id", "slot", key, order, "x", "y",
                      *(["features"] if features is not None else []))
