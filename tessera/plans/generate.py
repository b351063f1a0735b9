"""Generative captions: neighbour-weighted next-token choices decoded greedily."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import bleu as BL
from tessera.operators import nextword as NW
from tessera.operators import similarity as SIM
from tessera.operators import vocab as V
from tessera.plans.evaluate import caption_side, held_out, learned_tokenizer, neighbours_for_validation
from tessera.session import ensure_checkpoint_dir


def marker_id_values(vocab: DataFrame) -> tuple[int, int]:
    """(start id, end id): two rows read on the driver; both markers must survive the cut."""
    got = {r["word"]: r["id"] for r in V.marker_ids(vocab).collect()}
    if T.MARK_START not in got or T.MARK_END not in got:
        raise ValueError("marker words fell outside the vocabulary")
    return int(got[T.MARK_START]), int(got[T.MARK_END])


def corpus_model(captions: DataFrame, num_words: int = 10000, materialize: bool = True):
    """(vocab, encoded, corpus argmax (c1, next), bigram counts) from the given training captions.

    With ``materialize`` the vocabulary (at most ``num_words - 1`` rows) and the encoded
    captions are checkpointed once, reliably: each has several readers downstream (marker
    ids, n-gram counts, neighbour tables, decoding), which would otherwise each re-read and
    re-tokenize the raw text.
    """
    vocab = V.build_vocabulary(captions, num_words)
    if materialize:
        ensure_checkpoint_dir(captions.sparkSession)
        vocab = vocab.checkpoint(eager=True)
    enc = V.encode(captions, vocab)
    if materialize:
        enc = enc.checkpoint(eager=True)
    counts = NW.next_token_counts(enc, "tokens", 2)
    return vocab, enc, NW.argmax_next(counts, ["c1"]), counts


def corpus_greedy_decode(captions: DataFrame, num_words: int = 10000, max_tokens: int = 30,
                         key: str = "key", test: float = 0.2, seed: int = 42, strip: bool = True) -> DataFrame:
    """(query, tokens, text): the corpus-only chain from the start word (one word of context)."""
    vocab, enc, corpus, _ = corpus_model(caption_side(captions, "train", key, test, seed), num_words)
    start, end = marker_id_values(vocab)
    q = captions.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("query"))
    dec = NW.greedy_decode(q, start, end, corpus, max_tokens=max_tokens)
    return _with_text(dec, vocab, start, end, strip)


def _with_text(dec: DataFrame, vocab: DataFrame, start: int, end: int, strip: bool) -> DataFrame:
    """Add the text of the decoded ids; ``strip`` leaves the marker words out of it."""
    ids = T.strip_ids("tokens", [start, end]) if strip else F.col("tokens")
    rows = dec.select("query", F.lit(0).alias("_no"), "tokens", ids.alias("_shown"))
    return V.decode(rows, vocab, "query", "_no", "_shown", ("tokens",)).select("query", "tokens", "text")


def caption(queries: DataFrame, base: DataFrame, captions: DataFrame, k: int = 5, num_words: int = 10000,
            max_tokens: int = 30, key: str = "key", strip: bool = True) -> DataFrame:
    """(query, tokens, text) for a caller's own vectors.

    ``queries`` and ``base`` are (key, features); ``captions`` (key, caption_no, caption)
    belong to the base. Two words of neighbour context, backing off to one, then to the
    corpus bigram choice. ``strip=False`` keeps the end marker in the text.
    """
    vocab, enc, corpus, _ = corpus_model(captions, num_words)
    return _decode_near(SIM.nearest(queries, base, k, key, key), vocab, enc, corpus, max_tokens, key, strip)


def _decode_near(nb: DataFrame, vocab: DataFrame, enc: DataFrame, corpus: DataFrame, max_tokens: int, key: str,
                 strip: bool) -> DataFrame:
    start, end = marker_id_values(vocab)
    tri, bi = NW.neighbour_next_token(nb, enc, key)
    dec = NW.greedy_decode(nb.select("query").distinct(), start, end, corpus, tri, bi, max_tokens)
    return _with_text(dec, vocab, start, end, strip)


def generate_captions(captions: DataFrame, features: DataFrame, k: int = 5, num_words: int = 10000,
                      max_tokens: int = 30, key: str = "key", test: float = 0.2, seed: int = 42,
                      exact: bool = False, strip: bool = True, held: Column | None = None) -> DataFrame:
    """(query, tokens, text) for every held-out key with a vector, from the training side.

    ``exact`` holds out exactly ``ceil(test * n)`` keys, as in ``evaluate_captions``; ``held`` is a
    predicate of the held-out keys that is known already.
    """
    held = held_out(captions, key, test, seed, exact) if held is None else held
    vocab, enc, corpus, _ = corpus_model(caption_side(captions, "train", key, test, seed, held), num_words)
    nb = neighbours_for_validation(captions, features, k, key, test, seed, held=held)
    return _decode_near(nb, vocab, enc, corpus, max_tokens, key, strip)


def evaluate_generated(captions: DataFrame, features: DataFrame, k: int = 5, key: str = "key",
                       test: float = 0.2, seed: int = 42, tokenizer: Callable | None = None, weights: dict | None = None,
                       exact: bool = False, num_words: int = 10000, max_tokens: int = 30) -> DataFrame:
    """(metric, score): corpus BLEU of generated captions against held-out keys' captions."""
    held = held_out(captions, key, test, seed, exact)
    tokenizer = tokenizer or learned_tokenizer(caption_side(captions, "train", key, held=held))
    gen = generate_captions(captions, features, k, num_words, max_tokens, key, test, seed, held=held)
    hyp = gen.select(F.col("query").alias(key), tokenizer("text").alias("tokens"))
    refs = caption_side(captions, "val", key, test, seed, held).select(
        key, F.col("caption_no").alias("ref_no"), tokenizer("caption").alias("tokens"))
    return BL.corpus_bleu(hyp, refs, weights, key)


def held_out_cross_entropy(captions: DataFrame, num_words: int = 10000, alpha: float = 1.0,
                           key: str = "key", test: float = 0.2, seed: int = 42) -> DataFrame:
    """Bigram cross-entropy of held-out captions under the training-split corpus model."""
    vocab, _, _, counts = corpus_model(caption_side(captions, "train", key, test, seed), num_words)
    val = V.encode(caption_side(captions, "val", key, test, seed), vocab)
    m = F.size("tokens")
    pairs = val.filter(m >= 2).select(T.shift_input("tokens", m).alias("x"), T.shift_target("tokens", m).alias("y"))
    return NW.token_cross_entropy(counts, pairs, num_words, alpha)
