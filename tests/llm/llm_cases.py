"""Rows that every operator must bear, and helpers for brute-force comparisons."""

import re

import numpy as np
import pandas as pd

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "uid string, fp string, score string, key string, bucket string, kept string, part string, length string, start string")
_RNG = np.random.default_rng(7)
VOCABULARY = [f"{a}{b}{c}" for a in "bdfgklmnprstv" for b in "aeiou" for c in ("n", "r", "st", "lo", "mi")]


def prose(n: int, seed: int = 0) -> str:
    words = np.random.default_rng(seed).choice(VOCABULARY, n)
    return " ".join(words)


#: Nulls in any column, empty and very long texts, ties, repeated rows, odd characters.
TEXTS = [(1, prose(60, 1)), (2, None), (3, ""), (None, prose(60, 1)), (None, None), (5, prose(60, 1)), (5, prose(60, 1)), (5, prose(60, 2)),
         (7, prose(30_000, 3)), (8, " \n\t \x0b"), (9, "x" * 50_000), (10, "ñandú 你好 🙂 <|endoftext|> ▁x  a\n\n \n b\x00"), (11, "one"), (12, "\n".join(["same line here"] * 40))]


def edge_docs(spark):
    rows = [(i, t, None, None if n % 2 else "h", None, *["clash"] * 9) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def ascii_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def documents(sf_dir):
    return pd.read_parquet(f"{sf_dir}/documents.parquet")


def rows_of(df):
    return [tuple(r) for r in df.collect()]
