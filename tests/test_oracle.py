"""Registered queries against their DuckDB oracle on the smallest test tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import registry

from conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
FAST = ["word_counts", "split_keys", "split_sizes", "vocabulary", "encode", "decode", "training_batches",
        "bleu_statistics", "corpus_bleu", "knn", "retrieve_caption", "evaluate_captions",
        "next_token_counts", "cross_entropy", "read_captions", "extract_features", "encode_stream",
        "evaluate_captions_exact", "dense_index", "split_exact", "token_words", "ngram_counts",
        "normalize_images", "knn_cells", "abbreviations", "score_vectors", "resize_images", "random_caption", "group_captions",
        "generate_captions", "evaluate_generated"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    return v


def table(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for _, r in pdf.iterrows()), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_library_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    got = table(E.queries()[name](spark, SF001).toPandas())
    want = table(con.execute(E.oracle_sql()[name]).df())
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [r["metric"] for r in rows] == ["BLEU-1", "BLEU-2", "BLEU-3", "BLEU-4"]
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)


def test_flagship_holds_out_keys_on_the_smallest_tables(spark):
    rows = {r["metric"]: r["score"] for r in E.entry(spark).collect()}
    assert sorted(rows) == ["BLEU-1", "BLEU-2", "BLEU-3", "BLEU-4"]
    assert rows["BLEU-1"] > 0
