"""Word counts, frequency-ranked vocabulary, encode and decode by lookup.

Encoding and decoding look the tokens of a caption up inside its row, a whole Arrow batch at
a time: no token is exploded, sorted or shuffled. The vocabulary travels with the tasks when a
count of its rows shows at most ``LOOKUP_ROWS`` of them; a larger one is joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.session import ensure_checkpoint_dir

LOOKUP_ROWS = 1_000_000


Lookup = tuple[pa.Array, pa.Array]


def lookup(vocab: DataFrame) -> Lookup | None:
    """(words, ids) of a vocabulary of at most LOOKUP_ROWS rows, else None; read as Arrow, without Python objects."""
    table = vocab.select("word", F.col("id").cast("int").alias("id")).limit(LOOKUP_ROWS + 1).toArrow()
    if table.num_rows > LOOKUP_ROWS:
        return None
    return tuple(table.column(c).combine_chunks().cast(t) for c, t in (("word", pa.string()), ("id", pa.int32())))


def _looked_up(lists: pa.ListArray, known: pa.Array, values: pa.Array) -> pa.ListArray:
    """Each list's items replaced by the value beside their equal in ``known``, others left out."""
    n = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
    at = pc.index_in(lists.flatten(), value_set=known)
    found = np.asarray(at.is_valid())
    kept = np.bincount(np.repeat(np.arange(len(lists)), n)[found], minlength=len(lists))
    offsets = pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, values.take(at.drop_null()))


def _type(df: DataFrame, name: str) -> str:
    return f"`{name}` {df.schema[name].dataType.simpleString()}"


def exploded_words(df: DataFrame, key: str = "key", order: str = "caption_no",
                   text: str = "caption", marked: bool = True) -> DataFrame:
    """(key, caption_no, pos, word) for every training token; null texts give no rows."""
    src = T.mark(text) if marked else F.col(text)
    return df.select(key, order, F.posexplode(T.tokenize(src)).alias("pos", "word"))


def word_counts(df: DataFrame, key: str = "key", order: str = "caption_no",
                text: str = "caption", marked: bool = False) -> DataFrame:
    """(word, n): occurrences of every word (partial + final hash aggregation)."""
    words = exploded_words(df, key, order, text, marked)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def build_vocabulary(df: DataFrame, num_words: int = 10000, key: str = "key",
                     order: str = "caption_no", text: str = "caption",
                     marked: bool = True) -> DataFrame:
    """(word, id, n): ids from 1 by descending count, ties by first occurrence in
    (key, caption_no, position) order; only ids below ``num_words`` are kept.

    Words are counted by hash. The histogram of the counts gives the count below which no word
    can be kept, and the counts that several words share; first occurrences are looked for
    only among the tokens of those words, so the corpus is never sorted. The final top-N
    sees the words at or above the cut.
    """
    ensure_checkpoint_dir(df.sparkSession)
    most = max(num_words - 1, 0)
    words = exploded_words(df, key, order, text, marked)
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    # one row per distinct count: the words above it are those with a larger one
    above = F.sum("words").over(Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1))
    kept = (counted.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
            .withColumn("above", F.coalesce(above, F.lit(0))).filter(F.col("above") < most))
    counted = counted.join(kept.select("n", "words"), "n").checkpoint(eager=True)
    shared = counted.filter("words > 1").select("word")
    place = F.struct(F.col(key).alias("k"), F.col(order).alias("o"), F.col("pos").alias("p"))
    first = words.join(shared, "word", "left_semi").groupBy("word").agg(F.min(place).alias("first"))
    ranking = [F.col("n").desc(), F.col("first").asc()]
    top = counted.join(first, "word", "left").orderBy(*ranking).limit(most)
    return top.select(
        "word",
        F.row_number().over(Window.orderBy(*ranking)).cast("int").alias("id"),
        "n",
    )


def inverse_vocabulary(vocab: DataFrame) -> DataFrame:
    """(id, word): the same table keyed the other way."""
    return vocab.select("id", "word")


def marker_ids(vocab: DataFrame, words=(T.MARK_START, T.MARK_END)) -> DataFrame:
    """(word, id) of the marker words that survived the vocabulary cut."""
    return vocab.filter(F.col("word").isin(*words)).select("word", "id")


def encode(df: DataFrame, vocab: DataFrame, key: str = "key", order: str = "caption_no",
           text: str = "caption", marked: bool = True, known: Lookup | None = None) -> DataFrame:
    """(key, caption_no, tokens array<int>): words outside the vocabulary vanish, order kept.

    A caption with no known word, and a null caption, give ``[]``; one row per input row. ``known`` is
    the vocabulary's ``lookup`` where the caller has it already, as a stream does.
    """
    src = T.mark(text) if marked else F.col(text)
    rows = df.select(key, order, T.tokenize(src).alias("_words"))
    small = known or lookup(vocab)
    if small is None:
        words = rows.withColumn("_row", F.monotonically_increasing_id()).select(
            key, order, "_row", F.posexplode_outer("_words").alias("pos", "word"))
        looked = words.join(vocab.select("word", "id"), "word", "left")
        item = F.when(F.col("id").isNotNull(), F.struct(F.col("pos"), F.col("id")))
        return looked.groupBy(key, order, "_row").agg(
            F.transform(F.array_sort(F.collect_list(item)), lambda s: s["id"]).alias("tokens")).drop("_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = _looked_up(b.column("_words"), *small)
            yield pa.RecordBatch.from_arrays([b.column(key), b.column(order), tokens], names=[key, order, "tokens"])

    return rows.mapInArrow(run, f"{_type(df, key)}, {_type(df, order)}, tokens array<int>")


def token_to_word(ids: DataFrame, vocab: DataFrame, id_col: str = "id") -> DataFrame:
    """Add ``word``: 0 renders as one blank, other ids by lookup (unknown -> null)."""
    inv = inverse_vocabulary(vocab).withColumnRenamed("id", "_vid")
    return (ids.join(inv, F.col(id_col) == F.col("_vid"), "left")
            .withColumn("word", F.when(F.col(id_col) == T.PAD_ID, F.lit(" ")).otherwise(F.col("word")))
            .drop("_vid"))


def decode(df: DataFrame, vocab: DataFrame, key: str = "key", order: str = "caption_no",
           tokens: str = "tokens", keep: tuple = ()) -> DataFrame:
    """(key, caption_no, keep.., text): padding and unknown ids skipped, words joined by one blank."""
    small = lookup(vocab)
    columns = [key, order, *keep]
    if small is None:
        exploded = df.withColumn("_row", F.monotonically_increasing_id()).select(
            *columns, "_row", F.posexplode_outer(tokens).alias("pos", "_tid"))
        looked = exploded.join(inverse_vocabulary(vocab), F.col("_tid") == F.col("id"), "left")
        item = F.when((F.col("_tid") != T.PAD_ID) & F.col("word").isNotNull(), F.struct(F.col("pos"), F.col("word")))
        return looked.groupBy(*columns, "_row").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda s: s["word"]), " ")
            .alias("text")).drop("_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = _looked_up(b.column("_ids"), small[1], small[0])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), pc.binary_join(words, " ")], names=[*columns, "text"])

    rows = df.select(*columns, F.filter(tokens, lambda x: x != T.PAD_ID).cast("array<int>").alias("_ids"))
    return rows.mapInArrow(run, ", ".join(_type(df, c) for c in columns) + ", text string")
