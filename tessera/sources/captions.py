"""Caption sources: CSV reader, key renaming, caption numbering, missing-value handling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.indexing import rank_within

def read_captions(spark: SparkSession, path: str, key_col: str = "image", text_col: str = "caption",
                  key: str = "key", number: bool = True, multi_line: bool | None = True) -> DataFrame:
    """(key, caption_no, caption) from comma-separated files with a header.

    Columns are found by their names in the header, in any place; others are read past, and a
    missing one is an error, also in a later file whose header differs. Doubled quotes and
    quoted newlines are kept; an empty field reads as null and the text ``NA`` stays text.
    With ``number`` the caption order inside its file becomes ``caption_no`` (0-based per key,
    files in path order).

    With ``multi_line``, the default, a file is read by one task, which many files of up to some hundred
    MB bear well. Few large files are better split, by ``multi_line=False``: right where no field holds a
    newline. ``None`` looks first (``has_quoted_newlines``), which reads the files once more, in parallel.
    """
    if multi_line is None:
        multi_line = has_quoted_newlines(spark, path)
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    missing = {key_col, text_col} - set(names)
    if missing:
        raise ValueError(f"header lacks columns {sorted(missing)}: {names}")
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    df = reader.schema(schema).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    df = df.select(F.col(key_col).alias(key), F.col(text_col).alias("caption"), "_metadata")
    if not number:
        return df.drop("_metadata")
    # inside one block of a file the id follows the lines
    df = (df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_block", F.col("_metadata.file_block_start"))
          .withColumn("_row", F.monotonically_increasing_id()).drop("_metadata"))
    return caption_numbers(df, key, ["_file", "_block", "_row"]).drop("_file", "_block", "_row")


def has_quoted_newlines(spark: SparkSession, path: str) -> bool:
    """Whether a line has an odd number of quotes: without one, every record is a line of its own."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def rename_key(df: DataFrame, from_: str, to: str = "key") -> DataFrame:
    """Rename the key column (the reference renames ``image`` to ``filename``)."""
    if from_ not in df.columns:
        raise ValueError(f"no column {from_!r}")
    return df.withColumnRenamed(from_, to)


def caption_numbers(df: DataFrame, key: str = "key", order_cols: list | None = None,
                    name: str = "caption_no") -> DataFrame:
    """0-based caption number inside each key by ``order_cols`` (skew-safe global rank)."""
    return rank_within(df, key, order_cols or [], name)


def drop_missing(df: DataFrame, cols=("caption",)) -> DataFrame:
    """Rows with every column in ``cols`` present."""
    return df.na.drop(subset=list(cols))


def missing_counts(df: DataFrame, cols=("caption",)) -> DataFrame:
    """One row: total rows and rows that drop_missing would remove."""
    miss = F.lit(False)
    for c in cols:
        miss = miss | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(F.when(miss, 1).otherwise(0)).cast("bigint").alias("dropped"))
