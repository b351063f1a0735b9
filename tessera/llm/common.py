"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: Rows of a batch that are turned into Python objects at a time; bounds memory with long texts.
SLICE_ROWS = 256
#: Spark's setting by which a query removes its shuffle files when it ends (4.1; others ignore it).
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def narrow(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(doc_id, text, ...) only, so that other columns can neither clash nor be read."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder named by the session."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that are planned inside remove their shuffle files when they end."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table in the shared checkpoint folder: columns are compressed, which a checkpoint's rows are not.

    The shuffles that made the table are removed with the write; otherwise they would stay until the driver's next collection of garbage.
    """
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4()}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside lambdas Spark would evaluate ``value`` again for each element.
    """
    return F.transform(F.array(value), body)[0]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded row count."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's texts; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]
