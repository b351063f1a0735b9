"""Corpus and sentence BLEU (Papineni et al. 2002), all orders in one pass and one partitioning.

Inputs are long tables of token arrays:
  hyp : (key, tokens)            one hypothesis per key
  refs: (key, ref_no, tokens)    any number of references per key, a row each

Hypotheses and references are one table of counted n-grams: each row counts its own, exploded once
for the orders 1..max_n and, as order 0, its length. One shuffle by (key, n, gram) makes
the hypothesis' count, the largest count of a reference and their meeting at the same time; a second
one by key sums the matches and finds the closest length. Each side is read once.

Unsmoothed: any order with positive weight and zero matches gives 0. A hypothesis
shorter than n still adds 1 to that order's denominator (``max(1, count)``), the rule of
the library the reference calls. Hypotheses without any reference are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T

# The four weight sets the reference reports, BLEU-3 summing to 0.99 as given.
DEFAULT_WEIGHTS = {
    "BLEU-1": (1.0, 0.0, 0.0, 0.0),
    "BLEU-2": (0.5, 0.5, 0.0, 0.0),
    "BLEU-3": (0.33, 0.33, 0.33, 0.0),
    "BLEU-4": (0.25, 0.25, 0.25, 0.25),
}


def _counted_grams(df: DataFrame, key: str, tokens: str, max_n: int, is_hyp: bool) -> DataFrame:
    """(key, n, gram, h, r): the n-grams of each row with their counts; order 0 has the length as its gram."""
    t = F.coalesce(F.col(tokens), F.array().cast("array<string>"))

    def order(n: int) -> Column:
        return F.transform(T.counted(T.ngrams(t, n)), lambda x: F.struct(F.lit(n).alias("n"), x["item"].alias("gram"), x["c"].alias("c")))

    length = F.array(F.struct(F.lit(0).alias("n"), F.size(t).cast("string").alias("gram"), F.lit(1).alias("c")))
    rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.inline(F.concat(length, *map(order, range(1, max_n + 1)))))
    none = F.lit(None).cast("long")
    c = F.col("c").cast("long")
    return rows.select("key", "n", "gram", (c if is_hyp else none).alias("h"), (none if is_hyp else c).alias("r"))


def _key_statistics(hyp: DataFrame, refs: DataFrame, key: str, tokens: str, max_n: int) -> DataFrame:
    """(key, m1.., g1.., hyp_lens, ref_lens) of the keys with a hypothesis and a reference.

    ``m`` are clipped matches, ``g`` the hypothesis' n-grams, ``*_lens`` distinct lengths.
    """
    grams = _counted_grams(hyp, key, tokens, max_n, True).unionByName(_counted_grams(refs, key, tokens, max_n, False))
    met = grams.groupBy("key", "n", "gram").agg(F.sum("h").alias("h"), F.max("r").alias("r"))
    of = lambda n, v: F.sum(F.when(F.col("n") == n, v).otherwise(F.lit(0))).cast("bigint")
    match = F.when(F.col("h").isNotNull(), F.least("h", F.coalesce("r", F.lit(0)))).otherwise(F.lit(0))
    aggs = [f(n).alias(f"{name}{n}") for n in range(1, max_n + 1)
            for name, f in (("m", lambda n: of(n, match)), ("g", lambda n: of(n, F.coalesce("h", F.lit(0)))))]
    length = F.col("gram").try_cast("int")
    lens = [F.collect_list(F.when((F.col("n") == 0) & F.col(c).isNotNull(), length)).alias(name)
            for c, name in (("h", "hyp_lens"), ("r", "ref_lens"))]
    return met.groupBy("key").agg(*aggs, *lens).filter((F.size("hyp_lens") > 0) & (F.size("ref_lens") > 0))


def clipped_ngram_matches(hyp: DataFrame, refs: DataFrame, key: str = "key", tokens: str = "tokens",
                          max_n: int = 4) -> DataFrame:
    """(key, n, matches): sum over the hypothesis n-grams of min(hyp count, max ref count).

    A row for each order of which the hypothesis has an n-gram.
    """
    stats = _key_statistics(hyp, refs, key, tokens, max_n)
    orders = F.array(*[F.struct(F.lit(n).alias("n"), F.col(f"m{n}").alias("matches"), F.col(f"g{n}").alias("g")) for n in range(1, max_n + 1)])
    return stats.select(F.col("key").alias(key), F.inline(orders)).filter("g > 0").select(key, "n", "matches")


def closest_reference_length(hyp: DataFrame, refs: DataFrame, key: str = "key",
                             tokens: str = "tokens") -> DataFrame:
    """(key, hyp_len, ref_len): the reference length nearest the hypothesis, shorter on ties.

    Reference lengths are made distinct per key before the join, which bounds a hot key by
    its number of distinct lengths.
    """
    hl = hyp.select(key, F.size(tokens).alias("hyp_len"))
    rl = refs.select(key, F.size(tokens).alias("rl")).distinct()
    best = F.min(F.struct(F.abs(F.col("rl") - F.col("hyp_len")).alias("d"), F.col("rl").alias("rl")))
    return (rl.join(hl, key).groupBy(key, "hyp_len").agg(best.alias("_b"))
            .select(key, "hyp_len", F.col("_b.rl").alias("ref_len")))


def bleu_statistics(hyp: DataFrame, refs: DataFrame, key: str = "key", tokens: str = "tokens",
                    max_n: int = 4, by_key: bool = False) -> DataFrame:
    """Sufficient statistics: m1..m{max_n}, d1..d{max_n}, hyp_len, ref_len (per key or corpus)."""
    def closest(x):
        near = F.array_min(F.transform("ref_lens", lambda r: F.struct(F.abs(r - x).alias("d"), r.alias("r"))))
        return near["r"]

    total = lambda f: F.aggregate(F.transform("hyp_lens", lambda x: f(x).cast("bigint")), F.lit(0).cast("bigint"), lambda a, v: a + v)
    columns = [x for n in range(1, max_n + 1)
               for x in (F.col(f"m{n}"), total(lambda x, n=n: F.greatest(x - n + 1, F.lit(1))).alias(f"d{n}"))]
    stats = _key_statistics(hyp, refs, key, tokens, max_n).select(
        F.col("key").alias(key), *columns, total(lambda x: x).alias("hyp_len"), total(closest).alias("ref_len"))
    if by_key:
        return stats
    # an empty corpus has zero counts, not nulls
    return stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in stats.columns if c != key])


def _score(weights):
    logs, zero = F.lit(0.0), F.lit(False)
    for n, w in enumerate(weights, start=1):
        if w <= 0:
            continue
        m, d = F.col(f"m{n}"), F.col(f"d{n}")
        zero = zero | (m == 0)
        logs = logs + F.lit(float(w)) * F.log(m.cast("double") / d.cast("double"))
    c, r = F.col("hyp_len").cast("double"), F.col("ref_len").cast("double")
    bp = F.when(c > r, F.lit(1.0)).when(c == 0, F.lit(0.0)).otherwise(F.exp(F.lit(1.0) - r / c))
    return F.when(zero | (F.col("m1") == 0), F.lit(0.0)).otherwise(bp * F.exp(logs))


def _scores(weights: dict):
    """Array of (metric, score) structs over the statistics' columns."""
    return F.array(*[F.struct(F.lit(name).alias("metric"), _score(w).alias("score")) for name, w in weights.items()])


def _order(weights: dict) -> int:
    """The longest n-gram that any weight tuple asks for."""
    return max(len(w) for w in weights.values())


def corpus_bleu(hyp: DataFrame, refs: DataFrame, weights: dict | None = None, key: str = "key",
                tokens: str = "tokens") -> DataFrame:
    """(metric, score): numerators and denominators summed over the corpus before dividing."""
    weights = weights or DEFAULT_WEIGHTS
    stats = bleu_statistics(hyp, refs, key, tokens, _order(weights))
    return stats.select(F.inline(_scores(weights)))


def sentence_bleu(hyp: DataFrame, refs: DataFrame, weights: dict | None = None, key: str = "key",
                  tokens: str = "tokens") -> DataFrame:
    """(key, metric, score): the same statistics grouped by key."""
    weights = weights or DEFAULT_WEIGHTS
    stats = bleu_statistics(hyp, refs, key, tokens, _order(weights), by_key=True)
    return stats.select(key, F.inline(_scores(weights)))


def bleu_report(scores: DataFrame, decimals: int = 4) -> DataFrame:
    """Four named scores rounded for display."""
    return scores.select("metric", F.round("score", decimals).alias("score")).orderBy("metric")
