"""Query registry: every operator run on the stand-in tables, plus its DuckDB oracle SQL.

Each query takes (spark, sf_dir) and reads whole tables. Arrays are returned as text
(``array_join``) and floating results are rounded, so the Spark and DuckDB outputs can be
compared by value.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import batches as B
from tessera.operators import bleu as BL
from tessera.operators import sentences as SENT
from tessera.operators import split as S
from tessera.operators import vocab as V
from tessera.plans import evaluate as EV
from tessera.plans import generate as GEN
from tessera.operators import nextword as NW
from tessera.plans import sqlparts as Q
from tessera.operators import report as R
from tessera.sources import tables
from tessera.sources.captions import drop_missing

SEED = 42
TEST = 0.2
NUM_WORDS = 10000
BATCH = 384


# ----------------------------------------------------------------------------- helpers
def _captions(spark, sf):
    return tables.captions(spark, sf)


def _split(spark, sf):
    return S.split_by_key(_captions(spark, sf), "key", TEST, SEED)


def _train(spark, sf):
    return _split(spark, sf).filter(F.col("split") == "train").drop("split")


def _val(spark, sf):
    return _split(spark, sf).filter(F.col("split") == "val").drop("split")


def _vocab(spark, sf):
    return V.build_vocabulary(_train(spark, sf), NUM_WORDS)


def _ids_text(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


_WITH = f"WITH {Q.captions_cte()}, {Q.split_cte(SEED, TEST)}, {Q.train_cte()}"


# ----------------------------------------------------------------------------- queries
def q_word_counts(spark, sf):
    return V.word_counts(_captions(spark, sf))


def q_word_counts_documents(spark, sf):
    return V.word_counts(tables.documents(spark, sf))


def q_split_keys(spark, sf):
    return S.split_keys(_captions(spark, sf), "key", test=TEST, seed=SEED)


def q_split_sizes(spark, sf):
    return B.corpus_size(_split(spark, sf), "split")


def q_split_check(spark, sf):
    sp = _split(spark, sf)
    return S.check_split(sp.filter("split = 'train'"), sp.filter("split = 'val'"), _captions(spark, sf))


def q_train_captions(spark, sf):
    c = _captions(spark, sf)
    keys = S.split_keys(c).filter("split = 'train'")
    return S.select_split(c, keys)


def q_distinct_keys(spark, sf):
    return S.distinct_keys(_captions(spark, sf))


def q_captions_per_key(spark, sf):
    return B.captions_per_key(_captions(spark, sf))


def q_steps_per_epoch(spark, sf):
    return B.steps_per_epoch(_train(spark, sf), BATCH)


def q_group_captions(spark, sf):
    g = B.group_captions(_captions(spark, sf))
    return g.select("key", F.size("captions").alias("n"),
                    F.array_join("captions", " | ").alias("captions_text"))


def q_random_caption(spark, sf):
    return B.random_caption(_captions(spark, sf), 7).select("key", "caption_no")


def q_sample_keys(spark, sf):
    return S.sample_keys(_captions(spark, sf), 10, 7)


def q_first_keys(spark, sf):
    return S.first_n_keys(_val(spark, sf), 100)


def q_vocabulary(spark, sf):
    return _vocab(spark, sf)


def q_vocabulary_documents(spark, sf):
    return V.build_vocabulary(tables.documents(spark, sf), NUM_WORDS, marked=False)


def q_marker_ids(spark, sf):
    return V.marker_ids(_vocab(spark, sf))


def q_encode(spark, sf):
    e = V.encode(_train(spark, sf), _vocab(spark, sf))
    return e.select("key", "caption_no", F.size("tokens").alias("n_tokens"), _ids_text("tokens").alias("tokens"))


def q_encode_documents(spark, sf):
    d = tables.documents(spark, sf)
    v = V.build_vocabulary(d, NUM_WORDS, marked=False)
    e = V.encode(d, v, marked=False)
    return e.select("key", F.size("tokens").alias("n_tokens"), _ids_text("tokens").alias("tokens"))


def q_decode(spark, sf):
    v = _vocab(spark, sf)
    e = V.encode(_train(spark, sf), v)
    return V.decode(e, v)


def q_training_batches(spark, sf):
    tr = _train(spark, sf)
    e = V.encode(tr, _vocab(spark, sf))
    b = B.draw_batches(e, tables.features(spark, sf), BATCH, seed=SEED)
    return b.select("batch_id", "slot", "key", "caption_no",
                    F.size("x").alias("n_x"), _ids_text("x").alias("x"), _ids_text("y").alias("y"),
                    F.size("features").alias("n_features"),
                    F.round(F.aggregate("features", F.lit(0.0).cast("double"),
                                        lambda a, v: a + v.cast("double")), 6).alias("features_sum"))


def q_batch_max_length(spark, sf):
    tr = _train(spark, sf)
    e = V.encode(tr, _vocab(spark, sf))
    b = B.draw_batches(e, None, BATCH, seed=SEED)
    return B.batch_max_length(b, "x").withColumn("max_len", (F.col("max_len") + 1).cast("bigint"))


def _turn_corpus(spark, sf):
    """Hypothesis = turn 0 of each conversation, references = its later turns."""
    c = _captions(spark, sf)
    hyp = c.filter(F.col("caption_no") == 0).select("key", T.tokenize("caption").alias("tokens"))
    refs = c.filter(F.col("caption_no") > 0).select(
        "key", F.col("caption_no").alias("ref_no"), T.tokenize("caption").alias("tokens"))
    return hyp, refs


def q_bleu_statistics(spark, sf):
    return BL.bleu_statistics(*_turn_corpus(spark, sf))


def q_corpus_bleu(spark, sf):
    return BL.corpus_bleu(*_turn_corpus(spark, sf)).select("metric", F.round("score", 6).alias("score"))


def q_sentence_bleu(spark, sf):
    return BL.sentence_bleu(*_turn_corpus(spark, sf)).select(
        "key", "metric", F.round("score", 6).alias("score"))


def q_closest_reference_length(spark, sf):
    return BL.closest_reference_length(*_turn_corpus(spark, sf))


def q_clipped_matches(spark, sf):
    return BL.clipped_ngram_matches(*_turn_corpus(spark, sf))


K = 5


def q_knn(spark, sf):
    return EV.neighbours_for_validation(_captions(spark, sf), tables.features(spark, sf), K, test=TEST, seed=SEED)


def q_knn_cells(spark, sf):
    """The same neighbours through small cells and blocks, as a base of many blocks has them."""
    return EV.neighbours_for_validation(_captions(spark, sf), tables.features(spark, sf), K, test=TEST, seed=SEED,
                                        block_rows=64, cell_rows=16)


def q_retrieve_caption(spark, sf):
    p = EV.predict_captions(_captions(spark, sf), tables.features(spark, sf), K, test=TEST, seed=SEED)
    return p.select("query", "key", "caption_no", F.round("score", 6).alias("score"))


def q_evaluate_captions(spark, sf):
    e = EV.evaluate_captions(_captions(spark, sf), tables.features(spark, sf), K, test=TEST, seed=SEED)
    return e.select("metric", F.round("score", 6).alias("score"))


def q_evaluate_captions_exact(spark, sf):
    e = EV.evaluate_captions(_captions(spark, sf), tables.features(spark, sf), K, test=TEST, seed=SEED,
                             exact=True)
    return e.select("metric", F.round("score", 6).alias("score"))


def flagship(spark, sf):
    """entry(): the evaluation plan, BLEU report rounded to 4 decimals.

    Uses the exact split, so a small table (20 keys at sf0.001) still holds out 4 keys.
    """
    e = EV.evaluate_captions(_captions(spark, sf), tables.features(spark, sf), K, test=TEST, seed=SEED,
                             exact=True)
    return BL.bleu_report(e)


def q_eval_word_counts(spark, sf):
    c = _captions(spark, sf)
    return c.select(F.explode(EV.learned_tokenizer(c)("caption")).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def q_abbreviations(spark, sf):
    """Abbreviations that the documents use, with the counts behind them."""
    found = SENT.abbreviations(tables.documents(spark, sf))
    return found.select("type", "n", "n_period", F.round("score", 6).alias("score"))


def _train_encoded(spark, sf):
    tr = _train(spark, sf)
    return V.encode(tr, _vocab(spark, sf))


def q_next_token_counts(spark, sf):
    return NW.next_token_counts(_train_encoded(spark, sf), "tokens", 2)


def q_trigram_counts(spark, sf):
    return NW.next_token_counts(_train_encoded(spark, sf), "tokens", 3)


def q_argmax_next(spark, sf):
    return NW.argmax_next(NW.next_token_counts(_train_encoded(spark, sf), "tokens", 2), ["c1"])


def q_cross_entropy(spark, sf):
    ce = GEN.held_out_cross_entropy(_captions(spark, sf), NUM_WORDS, 1.0, test=TEST, seed=SEED)
    return ce.select("pairs", F.round("cross_entropy", 6).alias("cross_entropy"),
                     F.round("perplexity", 4).alias("perplexity"))


def q_corpus_greedy_decode(spark, sf):
    d = GEN.corpus_greedy_decode(_captions(spark, sf), NUM_WORDS, 30, test=TEST, seed=SEED)
    return d.select("query", F.size("tokens").alias("n_tokens"), _ids_text("tokens").alias("tokens"), "text")


def q_generate_captions(spark, sf):
    d = GEN.generate_captions(_captions(spark, sf), tables.features(spark, sf), K, NUM_WORDS, 30,
                              test=TEST, seed=SEED)
    return d.select("query", F.size("tokens").alias("n_tokens"), _ids_text("tokens").alias("tokens"), "text")


def q_evaluate_generated(spark, sf):
    e = GEN.evaluate_generated(_captions(spark, sf), tables.features(spark, sf), K, test=TEST, seed=SEED)
    return e.select("metric", F.round("score", 6).alias("score"))


def q_plain_word_counts(spark, sf):
    c = _captions(spark, sf)
    return c.select(F.explode(T.plain_tokenize("caption")).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def q_captions_of(spark, sf):
    c = _captions(spark, sf)
    first = _val(spark, sf).agg(F.min("key")).first()[0]
    return R.captions_of(c, first)


def q_drop_missing(spark, sf):
    """Turns of the assistant have their text removed; those rows are dropped."""
    t = tables.table(spark, sf, "conversations")
    c = t.select(F.col("conv_id").alias("key"), F.col("turn").alias("caption_no"),
                 F.when(F.col("role") != "assistant", F.col("text")).alias("caption"))
    return drop_missing(c)


def q_token_lengths(spark, sf):
    return _captions(spark, sf).select("key", "caption_no", T.token_lengths(T.tokenize("caption")).alias("n"))


def q_strip_markers(spark, sf):
    marked = T.tokenize(T.mark("caption"))
    return _captions(spark, sf).select("key", "caption_no", F.array_join(T.strip_markers(marked), " ").alias("words"))


def q_bleu_report(spark, sf):
    return BL.bleu_report(BL.corpus_bleu(*_turn_corpus(spark, sf)))


def q_cross_entropy_padded(spark, sf):
    """The loss over padded training batches, padding included, under the training model."""
    e = _train_encoded(spark, sf)
    b = B.draw_batches(e, None, BATCH, seed=SEED)
    ce = NW.token_cross_entropy(NW.next_token_counts(e), b, NUM_WORDS, 1.0, include_padding=True)
    return ce.select("pairs", F.round("cross_entropy", 6).alias("cross_entropy"), F.round("perplexity", 4).alias("perplexity"))


QUERIES = {
    "plain_word_counts": q_plain_word_counts,
    "captions_of": q_captions_of,
    "drop_missing": q_drop_missing,
    "token_lengths": q_token_lengths,
    "strip_markers": q_strip_markers,
    "bleu_report": q_bleu_report,
    "cross_entropy_padded": q_cross_entropy_padded,
    "word_counts": q_word_counts,
    "word_counts_documents": q_word_counts_documents,
    "split_keys": q_split_keys,
    "split_sizes": q_split_sizes,
    "split_check": q_split_check,
    "train_captions": q_train_captions,
    "distinct_keys": q_distinct_keys,
    "captions_per_key": q_captions_per_key,
    "steps_per_epoch": q_steps_per_epoch,
    "group_captions": q_group_captions,
    "random_caption": q_random_caption,
    "sample_keys": q_sample_keys,
    "first_keys": q_first_keys,
    "vocabulary": q_vocabulary,
    "vocabulary_documents": q_vocabulary_documents,
    "marker_ids": q_marker_ids,
    "encode": q_encode,
    "encode_documents": q_encode_documents,
    "decode": q_decode,
    "training_batches": q_training_batches,
    "batch_max_length": q_batch_max_length,
    "bleu_statistics": q_bleu_statistics,
    "corpus_bleu": q_corpus_bleu,
    "sentence_bleu": q_sentence_bleu,
    "closest_reference_length": q_closest_reference_length,
    "clipped_matches": q_clipped_matches,
    "eval_word_counts": q_eval_word_counts,
    "abbreviations": q_abbreviations,
    "knn": q_knn,
    "knn_cells": q_knn_cells,
    "retrieve_caption": q_retrieve_caption,
    "evaluate_captions": q_evaluate_captions,
    "evaluate_captions_exact": q_evaluate_captions_exact,
    "next_token_counts": q_next_token_counts,
    "trigram_counts": q_trigram_counts,
    "argmax_next": q_argmax_next,
    "cross_entropy": q_cross_entropy,
    "corpus_greedy_decode": q_corpus_greedy_decode,
    "generate_captions": q_generate_captions,
    "evaluate_generated": q_evaluate_generated,
}


# ----------------------------------------------------------------------------- oracle SQL
_DOCS = "docs AS (SELECT doc_id AS key, CAST(0 AS BIGINT) AS caption_no, text AS caption FROM documents)"

_BATCH_SQL = f"""{_WITH},
{Q.vocab_cte('train', NUM_WORDS)},
{Q.encode_cte('train')},
cap AS (SELECT *, row_number() OVER (ORDER BY key, caption_no) - 1 AS gidx FROM encoded),
pk AS (SELECT key, min(gidx) AS first, count(*) AS n FROM cap GROUP BY key),
keys AS (SELECT *, row_number() OVER (ORDER BY key) - 1 AS kidx FROM pk),
sizes AS (SELECT (SELECT count(*) FROM keys) AS n_keys, (SELECT count(*) FROM cap) // {BATCH} AS steps),
draws AS (SELECT unnest(range(steps * {BATCH})) AS draw, n_keys FROM sizes),
d2 AS (SELECT draw, draw // {BATCH} AS batch_id, CAST(draw % {BATCH} AS INTEGER) AS slot,
              {Q.h(f'{SEED}:0:k', 'draw')} % n_keys AS kidx FROM draws),
picked AS (
  SELECT d2.batch_id, d2.slot, c.key, c.caption_no, c.tokens
  FROM d2 JOIN keys k USING (kidx)
  JOIN cap c ON c.gidx = k.first + {Q.h(f'{SEED}:0:c', 'd2.draw')} % k.n
),
padded AS (
  SELECT *, max(len(tokens)) OVER (PARTITION BY batch_id) AS m FROM picked
),
shifted AS (
  SELECT batch_id, slot, key, caption_no, m,
         list_concat(tokens, list_transform(range(greatest(m - len(tokens), 0)), lambda i: 0))[1:m] AS p
  FROM padded
)"""

ORACLE = {
    "word_counts": f"""
SELECT word, count(*) AS n FROM (SELECT unnest({Q.tok('text')}) AS word FROM conversations) GROUP BY word""",
    "word_counts_documents": f"""
SELECT word, count(*) AS n FROM (SELECT unnest({Q.tok('text')}) AS word FROM documents) GROUP BY word""",
    "split_keys": f"{_WITH} SELECT key, split FROM split",
    "split_sizes": f"""{_WITH}
SELECT s.split, count(*) AS n_captions, count(DISTINCT c.key) AS n_keys
FROM captions c JOIN split s USING (key) GROUP BY s.split""",
    "split_check": f"""{_WITH},
t AS (SELECT DISTINCT key FROM split WHERE split = 'train'),
v AS (SELECT DISTINCT key FROM split WHERE split = 'val'),
a AS (SELECT DISTINCT key FROM captions),
u AS (SELECT key FROM t UNION SELECT key FROM v)
SELECT 'overlap' AS "check", (SELECT count(*) FROM (SELECT key FROM t INTERSECT SELECT key FROM v)) AS n
UNION ALL SELECT 'uncovered', (SELECT count(*) FROM (SELECT key FROM a EXCEPT SELECT key FROM u))
UNION ALL SELECT 'extra', (SELECT count(*) FROM (SELECT key FROM u EXCEPT SELECT key FROM a))
UNION ALL SELECT 'n_train', (SELECT count(*) FROM t)
UNION ALL SELECT 'n_val', (SELECT count(*) FROM v)""",
    "train_captions": f"{_WITH} SELECT key, caption_no, caption FROM train",
    "distinct_keys": "SELECT DISTINCT conv_id AS key FROM conversations",
    "captions_per_key": "SELECT conv_id AS key, count(*) AS n FROM conversations GROUP BY conv_id",
    "steps_per_epoch": f"{_WITH} SELECT CAST(floor(count(*) / {BATCH}) AS BIGINT) AS steps FROM train",
    "group_captions": f"""
SELECT conv_id AS key, count(*) AS n, string_agg(text, ' | ' ORDER BY turn) AS captions_text
FROM conversations GROUP BY conv_id""",
    "random_caption": f"""
SELECT conv_id AS key, arg_min(turn, ({Q.h('7', 'conv_id', 'turn')}, turn)) AS caption_no
FROM conversations GROUP BY conv_id""",
    "sample_keys": f"""
SELECT key FROM (SELECT DISTINCT conv_id AS key FROM conversations)
ORDER BY {Q.h('7', 'key')}, key LIMIT 10""",
    "first_keys": f"{_WITH} SELECT key FROM split WHERE split = 'val' ORDER BY key LIMIT 100",
    "vocabulary": f"{_WITH}, {Q.vocab_cte('train', NUM_WORDS)} SELECT word, id, n FROM vocab",
    "vocabulary_documents": f"""WITH {_DOCS}, {Q.vocab_cte('docs', NUM_WORDS, marked=False)}
SELECT word, id, n FROM vocab""",
    "marker_ids": f"""{_WITH}, {Q.vocab_cte('train', NUM_WORDS)}
SELECT word, id FROM vocab WHERE word IN ('ssss', 'eeee')""",
    "encode": f"""{_WITH}, {Q.vocab_cte('train', NUM_WORDS)}, {Q.encode_cte('train')}
SELECT key, caption_no, CAST(len(tokens) AS INTEGER) AS n_tokens, {Q.ids_text('tokens')} AS tokens FROM encoded""",
    "encode_documents": f"""WITH {_DOCS}, {Q.vocab_cte('docs', NUM_WORDS, marked=False)},
{Q.encode_cte('docs', marked=False)}
SELECT key, CAST(len(tokens) AS INTEGER) AS n_tokens, {Q.ids_text('tokens')} AS tokens FROM encoded""",
    "decode": f"""{_WITH}, {Q.vocab_cte('train', NUM_WORDS)}, {Q.encode_cte('train')},
dec AS (
  SELECT e.key, e.caption_no, unnest(range(len(e.tokens))) AS pos, unnest(e.tokens) AS tid FROM encoded e
),
words AS (
  SELECT d.key, d.caption_no, string_agg(v.word, ' ' ORDER BY d.pos) AS text
  FROM dec d JOIN vocab v ON v.id = d.tid WHERE d.tid <> 0 GROUP BY d.key, d.caption_no
)
SELECT e.key, e.caption_no, coalesce(w.text, '') AS text
FROM encoded e LEFT JOIN words w ON e.key = w.key AND e.caption_no = w.caption_no""",
    "training_batches": f"""{_BATCH_SQL},
feats AS (SELECT vec_id AS key, embedding AS features FROM embeddings)
SELECT s.batch_id, s.slot, s.key, s.caption_no,
       CAST(s.m - 1 AS INTEGER) AS n_x,
       {Q.ids_text('s.p[1:s.m - 1]')} AS x, {Q.ids_text('s.p[2:s.m]')} AS y,
       CAST(len(f.features) AS INTEGER) AS n_features,
       round(list_reduce(list_prepend(0.0::DOUBLE, f.features::DOUBLE[]), lambda a, b: a + b), 6) AS features_sum
FROM shifted s JOIN feats f USING (key)""",
    "batch_max_length": f"""{_BATCH_SQL}
SELECT batch_id, CAST(max(m) AS BIGINT) AS max_len FROM shifted GROUP BY batch_id""",
}

_BLEU_SQL = f"""WITH
hyp0 AS (SELECT conv_id AS key, {Q.tok('text')} AS t FROM conversations WHERE turn = 0),
refs AS (SELECT conv_id AS key, turn AS ref_no, {Q.tok('text')} AS t FROM conversations WHERE turn > 0),
{Q.bleu_ctes()}"""

ORACLE.update({
    "bleu_statistics": f"{_BLEU_SQL} SELECT * FROM stats",
    "corpus_bleu": f"{_BLEU_SQL} {Q.bleu_scores_select('stats')}",
    "sentence_bleu": f"{_BLEU_SQL} {Q.bleu_scores_select('stats_by_key', by_key=True)}",
    "closest_reference_length": f"{_BLEU_SQL} SELECT key, hyp_len, ref_len FROM cl",
    "clipped_matches": f"{_BLEU_SQL} SELECT key, n, matches FROM mk",
})

_KNN_SQL = f"""{_WITH},
{Q.knn_ctes(K)}"""
_RETRIEVE_SQL = f"""{_KNN_SQL},
{Q.retrieve_ctes()}"""

ORACLE.update({
    "knn": f"{_KNN_SQL} SELECT query, neighbour, sim, rank FROM knn",
    "knn_cells": f"{_KNN_SQL} SELECT query, neighbour, sim, rank FROM knn",
    "retrieve_caption": f"{_RETRIEVE_SQL} SELECT query, key, caption_no, round(score, 6) AS score FROM best",
    "evaluate_captions": f"""{_RETRIEVE_SQL},
{Q.abbreviation_cte('train')},
hyp0 AS (SELECT query AS key, {Q.eval_tok('caption', 'known')} AS t FROM best, abbr),
refs AS (SELECT c.key, c.caption_no AS ref_no, {Q.eval_tok('c.caption', 'known')} AS t
         FROM abbr, captions c JOIN split s USING (key) WHERE s.split = 'val'),
{Q.bleu_ctes()}
{Q.bleu_scores_select('stats')}""",
})

_EXACT_SPLIT = f"""split AS (
  SELECT key, CASE WHEN r < ceil({TEST} * (SELECT count(DISTINCT key) FROM captions)) THEN 'val' ELSE 'train' END AS split
  FROM (SELECT key, row_number() OVER (ORDER BY {Q.h(str(SEED), 'key')}, key) - 1 AS r
        FROM (SELECT DISTINCT key FROM captions)))"""
ORACLE["evaluate_captions_exact"] = f"""WITH {Q.captions_cte()}, {_EXACT_SPLIT}, {Q.train_cte()},
{Q.knn_ctes(K)},
{Q.retrieve_ctes()},
{Q.abbreviation_cte('train')},
hyp0 AS (SELECT query AS key, {Q.eval_tok('caption', 'known')} AS t FROM best, abbr),
refs AS (SELECT c.key, c.caption_no AS ref_no, {Q.eval_tok('c.caption', 'known')} AS t
         FROM abbr, captions c JOIN split s USING (key) WHERE s.split = 'val'),
{Q.bleu_ctes()}
{Q.bleu_scores_select('stats')}"""

ORACLE["eval_word_counts"] = f"""WITH {Q.abbreviation_cte('conversations', 'text')}
SELECT word, count(*) AS n FROM (SELECT unnest({Q.eval_tok('text', 'known')}) AS word FROM conversations, abbr) GROUP BY word"""
ORACLE["abbreviations"] = f"""WITH {Q.abbreviation_cte('documents', 'text')}
SELECT type, n, n_period, round(score, 6) AS score FROM abbr_all WHERE score >= {SENT.THRESHOLD}"""

_MODEL_SQL = f"""{_WITH},
{Q.vocab_cte('train', NUM_WORDS)},
{Q.encode_cte('train')},
{Q.corpus_model_ctes()}"""


def _recursive(sql: str) -> str:
    return "WITH RECURSIVE " + sql[len("WITH "):]


_GEN_SQL = _recursive(f"""{_MODEL_SQL},
{Q.knn_ctes(K)},
{Q.neighbour_model_ctes()},
{Q.decode_ctes('(SELECT DISTINCT query FROM knn)', 30, neighbours=True)}""")

_GREEDY_SQL = _recursive(f"""{_MODEL_SQL},
{Q.decode_ctes('(SELECT CAST(0 AS BIGINT) AS query)', 30, neighbours=False)}""")

ORACLE.update({
    "next_token_counts": f"{_MODEL_SQL} SELECT c1, nxt AS next, cnt AS count FROM bigr",
    "trigram_counts": f"""{_MODEL_SQL},
trigr AS (SELECT t[i] AS c2, t[i + 1] AS c1, t[i + 2] AS nxt, count(*) AS cnt
          FROM (SELECT tokens AS t, unnest(range(1, len(tokens) - 1)) AS i FROM encoded) GROUP BY ALL)
SELECT c2, c1, nxt AS next, cnt AS count FROM trigr""",
    "argmax_next": f"{_MODEL_SQL} SELECT c1, nxt AS next FROM corp",
    "cross_entropy": f"""{_MODEL_SQL},
val AS (SELECT c.* FROM captions c JOIN split s USING (key) WHERE s.split = 'val'),
vwords AS (SELECT key, caption_no, unnest(range(len(t))) AS pos, unnest(t) AS word
           FROM (SELECT key, caption_no, {Q.tok(Q.mark('caption'))} AS t FROM val)),
venc AS (SELECT w.key, w.caption_no, list(v.id ORDER BY w.pos) AS t
         FROM vwords w JOIN vocab v USING (word) GROUP BY w.key, w.caption_no),
vpairs AS (SELECT t[i] AS c1, t[i + 1] AS nxt FROM (SELECT t, unnest(range(1, len(t))) AS i FROM venc)),
tot AS (SELECT c1, sum(cnt) AS ctx FROM bigr GROUP BY c1),
sc AS (SELECT CAST(coalesce(b.cnt, 0) + 1.0 AS DOUBLE) AS num,
              CAST(coalesce(t.ctx, 0) + 1.0 * {NUM_WORDS} AS DOUBLE) AS den
       FROM vpairs p LEFT JOIN bigr b ON b.c1 = p.c1 AND b.nxt = p.nxt LEFT JOIN tot t ON t.c1 = p.c1)
SELECT count(*) AS pairs, round(avg(-ln(num / den)), 6) AS cross_entropy,
       round(exp(avg(-ln(num / den))), 4) AS perplexity FROM sc""",
    "corpus_greedy_decode": f"{_GREEDY_SQL} {Q.decoded_select()}",
    "generate_captions": f"{_GEN_SQL} {Q.decoded_select()}",
    "evaluate_generated": f"""{_GEN_SQL},
{Q.abbreviation_cte('train')},
hyp0 AS (SELECT query AS key, {Q.eval_tok('text', 'known')} AS t FROM decoded, abbr),
refs AS (SELECT c.key, c.caption_no AS ref_no, {Q.eval_tok('c.caption', 'known')} AS t
         FROM abbr, captions c JOIN split s USING (key) WHERE s.split = 'val'),
{Q.bleu_ctes()}
{Q.bleu_scores_select('stats')}""",
})

ORACLE.update({
    "plain_word_counts": f"""
SELECT word, count(*) AS n FROM (SELECT unnest({Q.plain_tok('text')}) AS word FROM conversations) GROUP BY word""",
    "captions_of": f"{_WITH} SELECT caption FROM captions WHERE key = (SELECT min(key) FROM split WHERE split = 'val')",
    "drop_missing": """
SELECT conv_id AS key, turn AS caption_no, text AS caption FROM conversations
WHERE role IS NOT NULL AND role <> 'assistant' AND text IS NOT NULL""",
    "token_lengths": f"SELECT conv_id AS key, turn AS caption_no, CAST(len({Q.tok('text')}) AS INTEGER) AS n FROM conversations",
    "strip_markers": f"SELECT conv_id AS key, turn AS caption_no, array_to_string(list_filter({Q.tok('text')}, lambda x: x NOT IN ('ssss', 'eeee')), ' ') AS words FROM conversations",
    "bleu_report": f"{_BLEU_SQL} SELECT metric, round(score, 4) AS score FROM ({Q.bleu_scores_select('stats')})",
    "cross_entropy_padded": f"""{_BATCH_SQL},
bigr AS (SELECT t[i] AS c1, t[i + 1] AS nxt, count(*) AS cnt
         FROM (SELECT tokens AS t, unnest(range(1, len(tokens))) AS i FROM encoded) GROUP BY ALL),
vpairs AS (SELECT p[i] AS c1, p[i + 1] AS nxt FROM (SELECT p, unnest(range(1, m)) AS i FROM shifted)),
tot AS (SELECT c1, sum(cnt) AS ctx FROM bigr GROUP BY c1),
sc AS (SELECT CAST(coalesce(b.cnt, 0) + 1.0 AS DOUBLE) AS num, CAST(coalesce(t.ctx, 0) + 1.0 * {NUM_WORDS} AS DOUBLE) AS den
       FROM vpairs p LEFT JOIN bigr b ON b.c1 = p.c1 AND b.nxt = p.nxt LEFT JOIN tot t ON t.c1 = p.c1)
SELECT count(*) AS pairs, round(avg(-ln(num / den)), 6) AS cross_entropy, round(exp(avg(-ln(num / den))), 4) AS perplexity FROM sc""",
})

from tessera.plans import io_queries as _IO  # noqa: E402

QUERIES.update(_IO.QUERIES)
ORACLE.update(_IO.ORACLE)

from tessera.plans import array_queries as _AQ  # noqa: E402

QUERIES.update(_AQ.QUERIES)
ORACLE.update(_AQ.ORACLE)
