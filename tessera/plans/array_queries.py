"""Registered queries for numbering, exact splits, padding to words, flattening and n-grams.

Each reads the whole stand-in tables and has a DuckDB oracle on the original tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import batches as B
from tessera.operators import split as S
from tessera.operators import vocab as V
from tessera.operators.indexing import dense_index
from tessera.plans import sqlparts as Q
from tessera.plans.evaluate import caption_side
from tessera.sources import tables

SEED, TEST, NUM_WORDS = 42, 0.2, 10000
NGRAM_ORDERS = 4


def q_dense_index(spark, sf):
    """O30: 0-based position of every key in key order (range sort, no single-task window)."""
    return dense_index(S.distinct_keys(tables.captions(spark, sf)), ["key"], "idx")


def q_split_exact(spark, sf):
    """O33 exact: exactly ceil(0.2 n) keys held out, those with the lowest seeded hash."""
    return S.split_keys(tables.captions(spark, sf), "key", test=TEST, seed=SEED, exact=True)


def q_sorted_keys(spark, sf):
    """O35: keys in ascending order (the order groupby would give)."""
    return S.sort_keys(S.distinct_keys(tables.captions(spark, sf)))


def q_token_words(spark, sf):
    """O45 + O47: training captions encoded, zero-padded to their key's longest caption,
    and every position mapped back to a word (padding renders as one blank)."""
    train = caption_side(tables.captions(spark, sf), "train", "key", TEST, SEED)
    vocab = V.build_vocabulary(train, NUM_WORDS)
    enc = V.encode(train, vocab)
    longest = enc.groupBy("key").agg(F.max(F.size("tokens")).alias("m"))
    padded = enc.join(longest, "key").select("key", "caption_no", T.pad_post("tokens", F.col("m")).alias("p"))
    ids = padded.select("key", "caption_no", F.posexplode("p").alias("pos", "id"))
    return V.token_to_word(ids, vocab, "id").select(
        "key", "caption_no", F.col("pos").cast("int").alias("pos"), "id", "word")


def q_flatten_captions(spark, sf):
    """O49: nested caption lists flattened back to rows, position kept as caption_no."""
    return B.flatten_captions(B.group_captions(tables.captions(spark, sf)))


def q_ngram_counts(spark, sf):
    """O53: occurrences of every n-gram, n = 1..4, of the evaluation tokens, in one pass."""
    c = tables.captions(spark, sf).select(T.eval_tokenize("caption").alias("t"))
    orders = F.explode(F.sequence(F.lit(1), F.lit(NGRAM_ORDERS))).alias("n")
    grams = c.select("t", orders).select("n", F.explode(T.ngrams("t", F.col("n"))).alias("gram"))
    return grams.groupBy("n").agg(F.count(F.lit(1)).alias("total"),
                                  F.count_distinct("gram").alias("distinct_grams")) \
        .join(grams.groupBy("n", "gram").agg(F.count(F.lit(1)).alias("count"))
              .groupBy("n").agg(F.max("count").alias("max_count")), "n")


def q_ngram_table(spark, sf):
    """O53: the full (n, gram, count) table for n = 1..4."""
    c = tables.captions(spark, sf).select(T.eval_tokenize("caption").alias("t"))
    orders = F.explode(F.sequence(F.lit(1), F.lit(NGRAM_ORDERS))).alias("n")
    grams = c.select("t", orders).select("n", F.explode(T.ngrams("t", F.col("n"))).alias("gram"))
    return grams.groupBy("n", "gram").agg(F.count(F.lit(1)).alias("count"))


QUERIES = {
    "dense_index": q_dense_index,
    "split_exact": q_split_exact,
    "sorted_keys": q_sorted_keys,
    "token_words": q_token_words,
    "flatten_captions": q_flatten_captions,
    "ngram_counts": q_ngram_counts,
    "ngram_table": q_ngram_table,
}

_WITH = f"WITH {Q.captions_cte()}, {Q.split_cte(SEED, TEST)}, {Q.train_cte()}"

_GRAMS = f"""grams AS (
  SELECT n, array_to_string(t[i:i + n - 1], ' ') AS gram
  FROM (SELECT {Q.eval_tok('text')} AS t FROM conversations),
       (SELECT unnest(range(1, {NGRAM_ORDERS + 1})) AS n),
       LATERAL (SELECT unnest(range(1, greatest(len(t) - n + 2, 1))) AS i)
)"""

ORACLE = {
    "dense_index": """
SELECT key, row_number() OVER (ORDER BY key) - 1 AS idx FROM (SELECT DISTINCT conv_id AS key FROM conversations)""",
    "split_exact": f"""
WITH k AS (SELECT DISTINCT conv_id AS key FROM conversations),
r AS (SELECT key, row_number() OVER (ORDER BY {Q.h(str(SEED), 'key')}, key) - 1 AS r FROM k)
SELECT key, CASE WHEN r < ceil({TEST} * (SELECT count(*) FROM k)) THEN 'val' ELSE 'train' END AS split FROM r""",
    "sorted_keys": "SELECT DISTINCT conv_id AS key FROM conversations",
    "token_words": f"""{_WITH}, {Q.vocab_cte('train', NUM_WORDS)}, {Q.encode_cte('train')},
longest AS (SELECT key, max(len(tokens)) AS m FROM encoded GROUP BY key),
padded AS (
  SELECT e.key, e.caption_no,
         list_concat(e.tokens, list_transform(range(l.m - len(e.tokens)), lambda i: 0)) AS p
  FROM encoded e JOIN longest l USING (key)
),
ids AS (SELECT key, caption_no, CAST(unnest(range(len(p))) AS INTEGER) AS pos, unnest(p) AS id FROM padded)
SELECT i.key, i.caption_no, i.pos, i.id, CASE WHEN i.id = 0 THEN ' ' ELSE v.word END AS word
FROM ids i LEFT JOIN vocab v ON v.id = i.id""",
    "flatten_captions": """
SELECT conv_id AS key, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS caption_no,
       text AS caption FROM conversations""",
    "ngram_counts": f"""WITH {_GRAMS},
counted AS (SELECT n, gram, count(*) AS c FROM grams GROUP BY n, gram)
SELECT n, sum(c)::BIGINT AS total, count(*)::BIGINT AS distinct_grams, max(c) AS max_count
FROM counted GROUP BY n""",
    "ngram_table": f"""WITH {_GRAMS}
SELECT n, gram, count(*) AS count FROM grams GROUP BY n, gram""",
}
