"""Stand-in tables: map the test parquet files onto the captions / features model.

captions : key, caption_no, caption      (conversations: conv_id, turn, text)
features : key, features array<float>    (embeddings: vec_id, embedding)
documents: key, caption_no, caption      (documents: doc_id, 0, text) - volume test for text work
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("key"),
        F.col("turn").alias("caption_no"),
        F.col("text").alias("caption"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("key"),
        F.col("embedding").alias("features"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"),
        F.lit(0).cast("bigint").alias("caption_no"),
        F.col("text").alias("caption"),
    )
