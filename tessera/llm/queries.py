"""One registered query per operator: production parameters over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import collocations, decontaminate, exact_dedup, packing, quality, runs, sharding, simhash, sp_dropout, substring, token_counts, toxicity, url_filter
from tessera.llm.common import let


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    found = toxicity.score(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("full_hash")).alias("text_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.histogram(token_counts.length_counts(_table(spark, sf_dir, "documents")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op8_sp_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_dropout.round_trips(_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(_table(spark, sf_dir, "documents")).drop("uid")


def _with_period(doc_id: Column, text: Column) -> Column:
    """The text; of one document in ten, by a checksum of its id, with a tail of words that returns with a period."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")

    def tail(w):
        n = F.size(w).cast("long")
        a = g % n
        p = F.floor((n - a) / (3 + g % 8)) + 1
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return let(at, lambda x: F.array_join(F.transform(x, lambda i: F.get(w, i.cast("int"))), " "))

    return F.when(h % 10 == 0, let(words, lambda w: F.when(F.size(w) > 0, tail(w)))).otherwise(text)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", _with_period(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.find_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_sharding": op4_sharding,
    "op5_packing": op5_packing,
    "op6_url_filter": op6_url_filter,
    "op7_quality_rules": op7_quality_rules,
    "op8_sp_dropout": op8_sp_dropout,
    "op9_simhash": op9_simhash,
    "op10_substring": op10_substring,
    "op11_runs": op11_runs,
    "op12_collocations": op12_collocations,
    "op13_decontaminate": op13_decontaminate,
}

_SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: SQL for the queries that it can state; the others need a tokenizer, a 64-bit hash or a model.
ORACLE: dict[str, str] = {
    "op2_exact_dedup": f"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op7_quality_rules": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{_SPACE}'), lambda x: x <> '') AS ws FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + {quality.WINDOW - 1}], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {quality.WINDOW - 2})) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {quality.WINDOW})) AS p FROM rep) GROUP BY doc_id),
ln AS (SELECT doc_id, t, host, unnest(string_split(t, chr(10))) AS raw FROM d),
lw AS (SELECT doc_id, t, host, raw, trim(regexp_replace(lower(raw), '{_SPACE}', ' ', 'g')) AS line,
              len(list_filter(regexp_split_to_array(raw, '{_SPACE}'), lambda x: x <> '')) AS nw
       FROM ln WHERE regexp_replace(raw, '{_SPACE}', '', 'g') <> ''),
dup AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n FROM lw GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
held AS (SELECT host, line, count(DISTINCT t) AS n_docs FROM lw GROUP BY host, line),
bad AS (SELECT host, line FROM held JOIN hosts USING (host)
        WHERE n_docs > greatest({float(quality.MAX_LINE_DOCS)}::DOUBLE, n * {quality.MAX_LINE_SHARE}::DOUBLE)),
lost AS (SELECT doc_id, sum(nw) AS lost_words, count(*) AS lost_lines FROM lw JOIN bad USING (host, line) GROUP BY doc_id),
base AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
                CAST(length(regexp_replace(t, '{_SPACE}', '', 'g')) AS BIGINT) AS word_chars,
                CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
                CAST(coalesce(lost_words, 0) AS BIGINT) AS words_removed, CAST(coalesce(lost_lines, 0) AS BIGINT) AS lines_removed
         FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN lost USING (doc_id)),
judged AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND n_words - words_removed >= {quality.MIN_WORDS}
          AND n_words - words_removed >= {quality.MIN_WORDS_LEFT} * n_words AS kept FROM judged""",
    "op12_collocations": f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
totals AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
places AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, {collocations.MAX_WORDS + 1}) AS sizes(m) WHERE len(w) >= m),
f AS (SELECT lang, m, w[i:i + m - 1] AS ws, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a
      FROM places GROUP BY ALL HAVING count(*) >= {collocations.MIN_COUNT}),
cuts AS (SELECT lang, phrase, a, m, ws, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, t.n,
                  (1000::HUGEINT * c.a::HUGEINT * t.n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:c.k], ' ')
           JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:c.m], ' ') JOIN totals t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (SELECT lang, ws, a, m, k, unnest(range(1, m - k + 2)) AS i FROM (SELECT lang, ws, a, m, unnest(range(2, m)) AS k FROM f WHERE m > 2)),
covers AS (SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, max(a) AS cover FROM parts GROUP BY ALL),
kept AS (SELECT worst.* FROM worst LEFT JOIN covers USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < {collocations.COVER_PERCENT} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {collocations.TOP}""",
    "op13_decontaminate": f"""
WITH letters AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '{_WORD}') AS w FROM letters),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS w
      FROM benchmark),
sized AS (SELECT item, w, least(len(w), {decontaminate.SIZE}) AS n FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
sizes AS (SELECT DISTINCT n FROM win),
placed AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
found AS (SELECT doc_id, i, placed.n, item FROM placed JOIN win ON win.n = placed.n AND win.g = array_to_string(w[i:i + placed.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
         FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)""",
}
