"""Abbreviations learned from a corpus, without labels (Kiss and Strunk 2006).

A period ends a sentence or belongs to an abbreviation, which is what a tokenizer has to know before
it splits periods off. A word type is an abbreviation when it keeps company with a period far more
often than words do in general, is short, and has periods inside:

    score = log-likelihood ratio * exp(-letters) * (inner periods + 1) * letters ^ -(times without period)

The likelihood ratio compares "a period follows with the share p of periods among all words" with
"a period follows nearly always (0.99)". All counts are one aggregation over the words of the corpus,
by type, with map-side sums; a word that a third of the corpus repeats is one row per task.

Evaluation works on lower-case text, so types are lower case and the case of the next word gives no
evidence. Null texts hold no words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import BLANKS, OPENING, TRAILING
from tessera.session import ensure_checkpoint_dir

# Fixed values of the published method: the score from which a type counts as an abbreviation, and
# the share of periods after abbreviations.
THRESHOLD = 0.3
NEARLY_ALWAYS = 0.99
#: Learned types that may travel with the tasks as a set.
MOST = 100_000


def period_contexts(df: DataFrame, text: str = "caption") -> DataFrame:
    """(type, n, n_period): how often each lower-case type occurs, and with a period behind it.

    Quotes and brackets around a word and marks behind it are left off; an ellipsis is not a period.
    """
    words = df.select(F.explode(F.split(F.lower(F.col(text)), BLANKS)).alias("w"))
    words = words.select(F.regexp_replace(F.regexp_replace("w", f"^{OPENING}+", ""), f"{TRAILING}+$", "").alias("w")).filter("w <> ''")
    dot = F.col("w").rlike(r"[^.]\.$")
    return (words.select(F.when(dot, F.expr("left(w, length(w) - 1)")).otherwise(F.col("w")).alias("type"), dot.cast("long").alias("dot"))
            .groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("dot").alias("n_period")))


def abbreviations(df: DataFrame, text: str = "caption", threshold: float = THRESHOLD) -> DataFrame:
    """(type, n, n_period, score): types that the corpus uses as abbreviations; the type has no final period."""
    ensure_checkpoint_dir(df.sparkSession)
    counts = period_contexts(df, text).checkpoint(eager=True)
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_period").alias("d")).first()
    share = (total["d"] or 0) / (total["n"] or 1)
    if not 0 < share < 1:
        return counts.limit(0).withColumn("score", F.lit(0.0))
    n, with_dot = F.col("n"), F.col("n_period")
    log = lambda p: F.log(F.lit(p))
    ratio = 2 * (with_dot * log(NEARLY_ALWAYS) + (n - with_dot) * log(1 - NEARLY_ALWAYS)
                 - with_dot * log(share) - (n - with_dot) * log(1 - share))
    letters = F.length(F.replace("type", F.lit("."), F.lit("")))
    inner = F.length("type") - letters
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -(n - with_dot).cast("double"))
    return (counts.filter((F.col("n_period") > 0) & F.col("type").rlike(r"\p{L}"))
            .withColumn("score", score).filter(F.col("score") >= threshold))


def abbreviation_list(df: DataFrame, text: str = "caption", threshold: float = THRESHOLD) -> list[str]:
    """The learned types in order, for ``eval_tokenize``; an error above ``MOST``, where the threshold is too low."""
    found = abbreviations(df, text, threshold).select("type").limit(MOST + 1).toArrow().column("type").to_pylist()
    if len(found) > MOST:
        raise ValueError(f"more than {MOST} abbreviations at a threshold of {threshold}")
    return sorted(found)
