"""Next-token statistics, argmax, cross-entropy, and greedy decoding in one pass.

What the reference's decoder learns - P(next word | image, prefix) - is estimated here from
data: corpus n-gram counts (``next_token_counts``) and similarity-weighted counts over a
query's nearest training captions (``neighbour_next_token``). ``greedy_decode`` then runs
the reference's loop (start id, append the argmax, stop at the end id or ``max_tokens``)
for each query where its choices lie: one shuffle by query, no join per step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

WEIGHT_DECIMALS = 6
#: Contexts of the corpus model that travel with the tasks of a decode: 16 MB.
LOCAL_ROWS = 1_000_000


def _windows(tokens: str, n: int):
    t = F.col(tokens)
    cnt = F.size(t) - n + 1
    return F.when(cnt > 0, F.transform(F.sequence(F.lit(1), cnt), lambda i: F.slice(t, i, n))) \
        .otherwise(F.array().cast("array<array<int>>"))


def shifted_pairs(df: DataFrame, tokens: str = "tokens", n: int = 2, ids: tuple = ()) -> DataFrame:
    """(ids.., c{n-1}..c1, next): every length-n window of each id array; c1 is the last context id."""
    w = df.select(*ids, F.explode(_windows(tokens, n)).alias("_w"))
    ctx = [F.col("_w")[n - 1 - j].alias(f"c{j}") for j in range(n - 1, 0, -1)]
    return w.select(*ids, *ctx, F.col("_w")[n - 1].alias("next"))


def next_token_counts(df: DataFrame, tokens: str = "tokens", n: int = 2) -> DataFrame:
    """(c{n-1}..c1, next, count) over all sequences: partial + final hash aggregation."""
    pairs = shifted_pairs(df, tokens, n)
    ctx = [f"c{j}" for j in range(n - 1, 0, -1)]
    return pairs.groupBy(*ctx, "next").agg(F.count(F.lit(1)).alias("count"))


def argmax_next(counts: DataFrame, context: list, score: str = "count") -> DataFrame:
    """(context.., next): the highest-scoring next id per context, lowest id on ties."""
    best = F.max(F.struct(F.col(score).alias("s"), (-F.col("next")).alias("neg")))
    return counts.groupBy(*context).agg(best.alias("_b")).select(
        *context, (-F.col("_b.neg")).cast("int").alias("next"))


def token_cross_entropy(counts: DataFrame, batches: DataFrame, vocab_size: int, alpha: float = 1.0,
                        include_padding: bool = False, x: str = "x", y: str = "y") -> DataFrame:
    """One row (pairs, cross_entropy, perplexity) of a bigram model on (x, y) sequences.

    p(next | prev) = (count(prev, next) + alpha) / (count(prev) + alpha * vocab_size).
    With ``include_padding`` the padded positions count too, as in the reference's loss,
    which sets no mask.
    """
    pairs = batches.select(F.explode(F.arrays_zip(F.col(x).alias("prev"), F.col(y).alias("next"))).alias("_p")) \
        .select(F.col("_p.prev").alias("c1"), F.col("_p.next").alias("next"))
    if not include_padding:
        pairs = pairs.filter(F.col("next") != 0)
    # one row per distinct pair before the joins: the start word, in every sequence, is no hot key
    pairs = pairs.groupBy("c1", "next").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy("c1").agg(F.sum("count").alias("ctx"))
    scored = (pairs.join(counts.select("c1", "next", "count"), ["c1", "next"], "left")
              .join(totals, "c1", "left")
              .select("_n", (F.coalesce("count", F.lit(0)) + F.lit(alpha)).cast("double").alias("num"),
                      (F.coalesce("ctx", F.lit(0)) + F.lit(alpha * vocab_size)).cast("double").alias("den")))
    loss = F.sum(-F.log(F.col("num") / F.col("den")) * F.col("_n"))
    n = F.coalesce(F.sum("_n"), F.lit(0).cast("bigint"))
    return scored.agg(n.alias("pairs"), (loss / F.sum("_n")).alias("cross_entropy")) \
        .withColumn("perplexity", F.exp("cross_entropy"))


def neighbour_next_token(neighbours: DataFrame, encoded: DataFrame, key: str = "key",
                         tokens: str = "tokens"):
    """Similarity-weighted next-token choices from each query's neighbour captions.

    Returns two argmax tables: (query, c2, c1, next) over two words of context and
    (query, c1, next) over one. Weights are max(sim, 0), summed and rounded to 6 decimals
    before ranking; ties go to the lowest id.
    """
    near = neighbours.select("query", F.col("neighbour").alias(key),
                             F.greatest(F.col("sim"), F.lit(0.0)).alias("w"))
    # counted once per key that is a neighbour, so a popular one's captions are not copied per query
    used = encoded.select(key, tokens).join(near.select(key).distinct(), key, "left_semi")

    # every window of two ids is one of three's beginning, but for the last of a caption
    tri = shifted_pairs(used, tokens, 3, (key,)).groupBy(key, "c2", "c1", "next").agg(F.count(F.lit(1)).alias("_n"))
    last = F.slice(F.col(tokens), -2, 2)
    ends = used.filter(F.size(tokens) >= 2).select(key, last[0].alias("c1"), last[1].alias("next"), F.lit(1).cast("long").alias("_n"))
    bi = (tri.select(key, F.col("c2").alias("c1"), F.col("c1").alias("next"), "_n").unionByName(ends)
          .groupBy(key, "c1", "next").agg(F.sum("_n").alias("_n")))

    def weighted(counts: DataFrame, context: list) -> DataFrame:
        scores = (near.join(counts, key).groupBy("query", *context, "next")
                  .agg(F.round(F.sum(F.col("w") * F.col("_n")), WEIGHT_DECIMALS).alias("score")))
        return argmax_next(scores, ["query", *context], "score")

    return weighted(tri, ["c2", "c1"]), weighted(bi, ["c1"])


def _continue(table: dict, out: list[int], answer: int | None, corpus, start_id: int, end_id: int, max_tokens: int) -> bool:
    """Append ids until the caption ends (False) or the corpus' choice after its last word has to be asked for (True).

    ``corpus(word)`` gives that choice or None where it is known here; else ``answer`` is the choice
    for the first word that needs one, 0 for none.
    """
    while len(out) < max_tokens and (not out or out[-1] != end_id):
        last = out[-1] if out else start_id
        before = (out[-2] if len(out) > 1 else start_id) if out else None
        found = table.get((before, last)) or table.get((None, last))
        if found is None:
            if corpus is not None:
                found = corpus(last)
            elif answer is None:
                return True
            else:
                found, answer = answer or None, None
            if found is None:
                return False
        out.append(found)
    return False


def _small_corpus(corpus_next: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """(words, choices) sorted by word, of at most ``LOCAL_ROWS`` contexts; else None."""
    table = corpus_next.select(F.col("c1").cast("int").alias("c1"), F.col("next").cast("int").alias("next")).limit(LOCAL_ROWS + 1).toArrow()
    if table.num_rows > LOCAL_ROWS:
        return None
    words, after = (table.column(c).to_numpy().astype(np.int64) for c in ("c1", "next"))
    order = np.argsort(words)
    return words[order], after[order]


def greedy_decode(queries: DataFrame, start_id: int, end_id: int, corpus_next: DataFrame,
                  tri_next: DataFrame | None = None, bi_next: DataFrame | None = None,
                  max_tokens: int = 30) -> DataFrame:
    """(query, tokens array<int>) decoded greedily for every row of ``queries(query)``.

    Next id = two-word choice, else one-word choice, else the corpus choice (``corpus_next``:
    (c1, next)). A query stops after the end id (which is kept), after ``max_tokens`` ids,
    or when no table continues it. Null queries are left out.

    A query's choices are sorted together in one shuffle and its whole loop runs over them; a
    task holds one query's choices at a time, a row per distinct context of its neighbours'
    captions. The corpus choices travel with the tasks, two arrays of ints, when a count shows at
    most ``LOCAL_ROWS`` of them. A larger corpus stays a table: a query that runs out of its own
    choices asks for one word, the answers are joined, and the open queries go on, a round for
    each such step.
    """
    none = F.lit(None).cast("int")
    kind = queries.schema["query"].dataType.simpleString()
    choices = [d.select("query", (F.col("c2") if has else F.lit(None)).cast("int").alias("c2"), F.col("c1").cast("int"), F.col("next").cast("int"))
               for d, has in ((bi_next, False), (tri_next, True)) if d is not None]
    asked = (queries.filter(F.col("query").isNotNull()).groupBy("query").agg(F.count(F.lit(1)).alias("times"))
             .select("query", F.array().cast("array<int>").alias("tokens"), F.col("times"), none.alias("answer")))
    local = _small_corpus(corpus_next)

    def look(word: int) -> int | None:
        words, after = local
        at = int(np.searchsorted(words, word))
        return int(after[at]) if at < len(words) and words[at] == word else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, state, table = None, None, {}

        def done() -> pa.RecordBatch:
            tokens, times, answer = state
            tokens = list(tokens)
            wants = _continue(table, tokens, answer, look if local else None, start_id, end_id, max_tokens)
            last = (tokens[-1] if tokens else start_id) if wants else None
            return pa.RecordBatch.from_arrays([pa.array([query], of), pa.array([tokens], pa.list_(pa.int32())), pa.array([times], pa.int64()),
                                               pa.array([last], pa.int32())], names=["query", "tokens", "times", "wants"])

        of = None
        for b in batches:
            of = b.schema.field("query").type
            for q, c2, c1, found, tokens, times, answer in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if q != query:
                    if state:
                        yield done()
                    query, state, table = q, None, {}
                if c1 is None:
                    state = (tokens, times, answer)
                else:
                    table[c2, c1] = found
        if state:
            yield done()

    def step(open_rows: DataFrame, own: list[DataFrame]) -> DataFrame:
        rows = open_rows.select("query", none.alias("c2"), none.alias("c1"), none.alias("next"), "tokens", "times", "answer")
        for d in own:
            rows = rows.unionByName(d.filter(F.col("query").isNotNull()), allowMissingColumns=True)
        rows = rows.repartition("query").sortWithinPartitions("query")
        return rows.mapInArrow(run, f"query {kind}, tokens array<int>, times long, wants int")

    found = step(asked, choices)
    if local is None:
        ensure_checkpoint_dir(queries.sparkSession)
        choices = [d.checkpoint(eager=True) for d in choices]
        found, ended = found.checkpoint(eager=True), []
        while not (waiting := found.filter("wants IS NOT NULL")).isEmpty():  # max_tokens rounds at most
            ended.append(found.filter("wants IS NULL"))
            words = waiting.select("wants").distinct()
            answers = words.join(corpus_next.select(F.col("c1").cast("int").alias("wants"), F.col("next").cast("int").alias("answer")), "wants", "left")
            asking = waiting.join(answers, "wants").select("query", "tokens", "times", F.coalesce("answer", F.lit(0)).alias("answer"))
            found = step(asking, [d.join(waiting.select("query"), "query", "left_semi") for d in choices]).checkpoint(eager=True)
        for d in ended:
            found = found.unionByName(d)
    return found.select("query", "tokens", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("query", "tokens")
