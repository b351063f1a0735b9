"""Key-level splits, membership joins, key sampling and ordering.

Randomness is always a hash of (seed, value): the same rows come out on any partitioning,
after retries, and in the DuckDB oracle. ``rand()`` is never used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

HASH_BITS = 60
#: Bits of a histogram of the selection; it has at most 2^12 rows.
STEP_BITS = 12


def held_out_below(test: float) -> int:
    """Keys whose hash is below this are held out: a share of ``test`` of the hash's range."""
    return int(round(test * (1 << HASH_BITS)))


def seeded_hash(seed, *cols) -> Column:
    """Deterministic 60-bit hash of ``seed:v1:v2..`` as a bigint in [0, 2^60).

    md5 first 15 hex digits, read as a number; DuckDB writes the same thing as
    ``('0x' || substr(md5(..), 1, 15))::bigint``.
    """
    parts = [F.lit(str(seed))]
    for c in cols:
        parts += [F.lit(":"), (F.col(c) if isinstance(c, str) else c).cast("string")]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint")


def distinct_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """Unique keys (no implied order)."""
    return df.select(key).distinct()


def split_by_key(df: DataFrame, key: str = "key", test: float = 0.2, seed: int = 42,
                 exact: bool = False, train_name: str = "train", test_name: str = "val") -> DataFrame:
    """Add ``split`` so all rows of a key fall on the same side.

    Default: narrow hash rule, no shuffle; a key is held out when its 60-bit hash is below
    ``test * 2^60``. ``exact=True`` holds out exactly
    ``ceil(test * n_keys)`` keys - those with the lowest hash - by a cut that ``exact_held_out`` finds.
    Null keys are in the training split.
    """
    held = exact_held_out(df, key, test, seed) if exact else seeded_hash(seed, key) < F.lit(held_out_below(test))
    return df.withColumn("split", F.when(held, F.lit(test_name)).otherwise(F.lit(train_name)))


def kth_smallest(values: DataFrame, name: str, k: int, bits: int = HASH_BITS) -> tuple[int, int] | None:
    """(the ``k``-th smallest of a column of integers in [0, 2^bits), how many are smaller); None if there are fewer than ``k``.

    A distributed selection: a histogram over the next ``STEP_BITS`` bits, refined inside the one
    bucket that holds the value, until its values are few enough to read. Nothing is sorted; each step
    is a count with map-side sums and returns ``2 ** STEP_BITS`` rows at most.
    """
    low, before = 0, 0
    inside = values.select(F.col(name).alias("_v"))
    while bits:
        step = min(STEP_BITS, bits)
        bits -= step
        bucket = F.shiftright(F.col("_v") - F.lit(low), bits)
        rows = inside.groupBy(bucket.alias("_b")).count().collect()
        for b, n in sorted((r["_b"], r["count"]) for r in rows):
            if before + n >= k:
                low += b << bits
                break
            before += n
        else:
            return None
        inside = inside.filter((F.col("_v") >= low) & (F.col("_v") < low + (1 << bits)))
        if n <= 1 << STEP_BITS:
            found = sorted(r["_v"] for r in inside.collect())
            value = found[k - before - 1]
            return value, before + found.index(value)
    return low, before


def exact_held_out(df: DataFrame, key: str = "key", test: float = 0.2, seed: int = 42) -> Column:
    """Predicate that holds for exactly ``ceil(test * n)`` of the ``n`` keys, those with the lowest (hash, key).

    The keys are made distinct and written once, as narrow rows; the cut is the value of an order
    statistic of their hashes, so both sides are filters in the scan, without a sort or a join.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = (df.select(key).filter(F.col(key).isNotNull()).distinct()
            .withColumn("_h", seeded_hash(seed, key)).checkpoint(eager=True))
    m = math.ceil(test * keys.count())
    found = kth_smallest(keys, "_h", m) if m else None
    if found is None:
        return F.lit(False)
    cut, smaller = found
    h = seeded_hash(seed, key)
    # keys of one hash are told apart by their order; that there are two is a matter of 60 bits
    last = keys.filter(F.col("_h") == cut).orderBy(key).limit(m - smaller).agg(F.max(key).alias("k")).first()["k"]
    return (h < F.lit(cut)) | ((h == F.lit(cut)) & (F.col(key) <= F.lit(last)))


def in_side(side: str, key: str = "key", test: float = 0.2, seed: int = 42,
            train_name: str = "train", test_name: str = "val") -> Column:
    """Predicate: the row's key falls on ``side`` under the default hash split.

    Membership is a pure function of the key, so selecting one side of a table is a narrow
    filter in the scan stage - no distinct keys, no join, no shuffle.
    """
    held = seeded_hash(seed, key) < F.lit(held_out_below(test))
    if side == test_name:
        return held
    if side == train_name:
        return ~held
    raise ValueError(f"unknown side {side!r}")


def split_rows(df: DataFrame, side: str, key: str = "key", test: float = 0.2, seed: int = 42) -> DataFrame:
    """Rows of ``df`` on one side of the default hash split (narrow filter)."""
    return df.filter(in_side(side, key, test, seed))


def split_keys(df: DataFrame, key: str = "key", **kw) -> DataFrame:
    """(key, split) for every distinct key."""
    return split_by_key(df.select(key).distinct(), key, **kw)


def select_split(df: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Rows of ``df`` whose key is in ``keys``: a left-semi hash join, never a literal list."""
    return df.join(keys.select(key), key, "left_semi")


def check_split(train_keys: DataFrame, val_keys: DataFrame, all_keys: DataFrame,
                key: str = "key") -> DataFrame:
    """Rows (check, n): overlap, uncovered and extra must be 0; n_train, n_val are sizes.

    One pass: each key is flagged by the sides it occurs on, flags are merged per key, and the
    checks are counts of flag patterns.
    """
    sides = [d.select(key, *[F.lit(i == j).alias(f"_{j}") for j in range(3)])
             for i, d in enumerate((train_keys, val_keys, all_keys))]
    flags = sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy(key).agg(
        *[F.max(f"_{j}").alias(f"_{j}") for j in range(3)])
    t, v, a = F.col("_0"), F.col("_1"), F.col("_2")
    checks = {"overlap": t & v, "uncovered": a & ~(t | v), "extra": (t | v) & ~a, "n_train": t, "n_val": v}
    counts = flags.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("n")) for n in checks])))


def sample_keys(df: DataFrame, n: int, seed: int, key: str = "key") -> DataFrame:
    """``n`` distinct keys without replacement, chosen by seeded hash (top-n, bounded)."""
    return (df.select(key).distinct()
            .withColumn("_h", seeded_hash(seed, key))
            .orderBy("_h", key).limit(n).drop("_h"))


def first_n_keys(df: DataFrame, n: int = 100, key: str = "key") -> DataFrame:
    """At most ``n`` keys in ascending key order (the stated order for "the first n")."""
    return df.select(key).distinct().orderBy(key).limit(n)


def sort_keys(df: DataFrame, key: str = "key") -> DataFrame:
    """Output ordering by key (apply only at the end of a plan)."""
    return df.orderBy(key)
