"""Lookups and report tables: captions of one key, key by position, prediction report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.indexing import dense_index
from tessera.operators.split import sample_keys


def captions_of(df: DataFrame, value, key: str = "key", text: str = "caption") -> DataFrame:
    """Captions of one key: an equality filter Catalyst pushes into the parquet scan."""
    return df.filter(F.col(key) == F.lit(value)).select(text)


def show_captions(df: DataFrame, value, key: str = "key", order: str = "caption_no") -> DataFrame:
    """All captions of one key in caption order (the table form of the reference's printout)."""
    return df.filter(F.col(key) == F.lit(value)).orderBy(order)


def key_index(df: DataFrame, key: str = "key") -> DataFrame:
    """(key, idx): position of each distinct key in key order, numbered without one task."""
    return dense_index(df.select(key).distinct(), [key], "idx")


def by_index(df: DataFrame, i: int, key: str = "key", order: str = "caption_no") -> DataFrame:
    """Rows of the i-th key (0-based, key order); out of range gives an empty frame."""
    pick = key_index(df, key).filter(F.col("idx") == F.lit(int(i))).select(key)
    return df.join(pick, key, "left_semi").orderBy(order)


def prediction_report(pred: DataFrame, captions: DataFrame, n: int, seed: int, key: str = "key",
                      order: str = "caption_no", text: str = "caption",
                      predicted: str = "predicted") -> DataFrame:
    """(key, predicted, true_caption) for ``n`` seeded sample keys; true = first caption."""
    keys = sample_keys(pred.select(key), n, seed, key)
    first = captions.join(keys, key, "left_semi").groupBy(key).agg(
        F.min(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))).alias("_f"))
    return (pred.join(keys, key, "left_semi").select(key, predicted)
            .join(first.select(key, F.col("_f.t").alias("true_caption")), key, "left"))
