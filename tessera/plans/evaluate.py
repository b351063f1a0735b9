"""Split -> neighbours -> retrieved captions -> corpus BLEU: the evaluation plan end to end."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import bleu as BL
from tessera.operators import sentences as SENT
from tessera.operators import similarity as SIM
from tessera.operators import split as S
from tessera.session import ensure_checkpoint_dir


def held_out(captions: DataFrame, key: str = "key", test: float = 0.2, seed: int = 42, exact: bool = False) -> Column:
    """Predicate of the held-out keys: a rule on the key's hash, or exactly ``ceil(test * n)`` of the
    keys that have captions, those with the lowest hash (useful when there are few keys)."""
    if exact:
        return S.exact_held_out(captions, key, test, seed)
    return S.in_side("val", key, test, seed)


def caption_side(captions: DataFrame, side: str, key: str = "key", test: float = 0.2,
                 seed: int = 42, held: Column | None = None) -> DataFrame:
    """Captions on one side of the split: a narrow filter by ``held``, the hash rule if none is given."""
    held = held_out(captions, key, test, seed) if held is None else held
    return captions.filter(held if side == "val" else ~held)


def split_sides(captions: DataFrame, key: str = "key", test: float = 0.2, seed: int = 42, exact: bool = False):
    """(train keys, val keys) that have captions."""
    held = held_out(captions, key, test, seed, exact)
    return tuple(caption_side(captions, side, key, held=held).select(key).distinct() for side in ("train", "val"))


def neighbours_for_validation(captions: DataFrame, features: DataFrame, k: int = 5, key: str = "key",
                              test: float = 0.2, seed: int = 42, block_rows: int | None = None,
                              held: Column | None = None, cell_rows: int = SIM.CELL_ROWS, report: dict | None = None) -> DataFrame:
    """k nearest training vectors for every held-out key that has a vector.

    A vector takes part only when its key has captions (semi join on the side's keys).
    """
    q, b = (S.select_split(features, caption_side(captions, side, key, test, seed, held).select(key).distinct(), key)
            for side in ("val", "train"))
    return SIM.nearest(q, b, k, key, key, "features", block_rows, cell_rows=cell_rows, report=report)


def predict_captions(captions: DataFrame, features: DataFrame, k: int = 5, key: str = "key",
                     test: float = 0.2, seed: int = 42, held: Column | None = None) -> DataFrame:
    """(query, key, caption_no, caption, score): one retrieved caption per held-out key."""
    nb = neighbours_for_validation(captions, features, k, key, test, seed, held=held)
    return SIM.retrieve_caption(nb, caption_side(captions, "train", key, test, seed, held), key)


def learned_tokenizer(captions: DataFrame) -> Callable:
    """The evaluation tokenizer with the abbreviations that the captions use."""
    return partial(T.eval_tokenize, abbreviations=SENT.abbreviation_list(captions))


def evaluate_captions(captions: DataFrame, features: DataFrame, k: int = 5, key: str = "key",
                      test: float = 0.2, seed: int = 42, tokenizer: Callable | None = None,
                      weights: dict | None = None, exact: bool = False) -> DataFrame:
    """(metric, score): corpus BLEU of retrieved captions against each held-out key's own
    captions, both tokenized by ``tokenizer``: by default the evaluation tokenizer with the
    abbreviations of the training captions."""
    ensure_checkpoint_dir(captions.sparkSession)
    held = held_out(captions, key, test, seed, exact)
    tokenizer = tokenizer or learned_tokenizer(caption_side(captions, "train", key, held=held))
    pred = predict_captions(captions, features, k, key, test, seed, held)
    # one row per query, read twice by BLEU (matches and lengths): materialize it once
    hyp = pred.select(F.col("query").alias(key), tokenizer("caption").alias("tokens")).checkpoint(eager=True)
    refs = caption_side(captions, "val", key, test, seed, held).select(
        key, F.col("caption_no").alias("ref_no"), tokenizer("caption").alias("tokens"))
    return BL.corpus_bleu(hyp, refs, weights, key)
