"""DuckDB SQL fragments for the oracle queries, built from the same fixed values as the
Spark column functions so both sides tokenize and hash identically."""

from __future__ import annotations

from tessera.functions.text import (BLANKS, EVAL_PATTERN, EVAL_RULES_AFTER, EVAL_RULES_BEFORE, FILTER_PATTERN, INITIAL_OR_ORDINAL,
                                    MARK_END, MARK_START, OPENING, PERIOD_WORD, TRAILING)
from tessera.operators.sentences import NEARLY_ALWAYS, THRESHOLD
from tessera.operators.split import held_out_below


def tok(expr: str) -> str:
    """Training tokenizer in DuckDB."""
    return (f"list_filter(string_split(regexp_replace(lower({expr}), '{FILTER_PATTERN}', ' ', 'g'), ' '), "
            f"lambda x: x <> '')")


def eval_tok(expr: str, known: str = "[]") -> str:
    """Evaluation tokenizer in DuckDB: the same replacements; ``known`` is a list of abbreviations."""
    def replaced(text, rules):
        for pattern, replacement in rules:
            text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(replacement)}, 'g')"
        return text

    text = replaced(f"(' ' || lower({expr}) || ' ')", EVAL_RULES_BEFORE)
    words = f"regexp_split_to_array(regexp_replace({text}, '{BLANKS}$', ''), '{BLANKS}')"
    inner = f"regexp_extract(x, {_quoted(PERIOD_WORD)}, 1)"
    words = (f"list_transform({words}, lambda x, i: CASE WHEN i < len({words}) AND contains(x, '.') AND "
             f"(regexp_matches({inner}, '{INITIAL_OR_ORDINAL}') OR coalesce(list_contains({known}, {inner}), false)) "
             f"THEN regexp_replace(x, {_quoted(MARKED[0])}, {_quoted(MARKED[1])}) ELSE x END)")
    text = replaced(f"(' ' || array_to_string({words}, ' ') || ' ')", EVAL_RULES_AFTER)
    return f"list_filter(regexp_split_to_array({text}, '\\s+'), lambda x: x <> '')"


#: The final period of a word, and its mark.
MARKED = (r"\.([\])}>']*)$", "\u0001\\1")


def abbreviation_cte(src: str, text: str = "caption") -> str:
    """CTE ``abbr(known)``: one row with the list of abbreviations learned from the texts of ``src``."""
    return rf"""
abbr_words AS (SELECT regexp_replace(regexp_replace(w, {_quoted('^' + OPENING + '+')}, ''), {_quoted(TRAILING + '+$')}, '') AS w
               FROM (SELECT unnest(regexp_split_to_array(lower({text}), '{BLANKS}')) AS w FROM {src})),
abbr_types AS (SELECT CASE WHEN regexp_matches(w, '[^.]\.$') THEN w[1:len(w) - 1] ELSE w END AS type, regexp_matches(w, '[^.]\.$') AS dot
               FROM abbr_words WHERE w <> ''),
abbr_total AS (SELECT count(*) AS n, count(*) FILTER (WHERE dot) AS d FROM abbr_types),
abbr_counts AS (SELECT type, count(*) AS n, count(*) FILTER (WHERE dot) AS n_period, len(replace(type, '.', '')) AS letters FROM abbr_types GROUP BY type),
abbr_all AS (SELECT type, c.n, n_period,
                    2 * (n_period * ln({NEARLY_ALWAYS}) + (c.n - n_period) * ln({1 - NEARLY_ALWAYS})
                         - n_period * ln(d / t.n) - (c.n - n_period) * ln(1 - d / t.n))
                    * exp(-letters) * (len(type) - letters + 1) * pow(letters, -(c.n - n_period)) AS score
             FROM abbr_counts c, abbr_total t WHERE n_period > 0 AND d < t.n AND regexp_matches(type, '\p{{L}}')),
abbr AS (SELECT list(type) AS known FROM abbr_all WHERE score >= {THRESHOLD})"""


def plain_tok(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), {_quoted(EVAL_PATTERN)})"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def mark(expr: str) -> str:
    return f"('{MARK_START} ' || {expr} || ' {MARK_END}')"


def h(seed: str, *exprs: str) -> str:
    """seeded_hash: first 15 hex digits of md5('seed:v1:..') as BIGINT."""
    s = f"'{seed}'"
    for e in exprs:
        s += f" || ':' || CAST({e} AS VARCHAR)"
    return f"('0x' || substr(md5({s}), 1, 15))::BIGINT"


def captions_cte() -> str:
    return "captions AS (SELECT conv_id AS key, turn AS caption_no, text AS caption FROM conversations)"


def split_cte(seed: int = 42, test: float = 0.2) -> str:
    return (f"split AS (SELECT DISTINCT key, CASE WHEN {h(str(seed), 'key')} < {held_out_below(test)} "
            f"THEN 'val' ELSE 'train' END AS split FROM captions)")


def train_cte() -> str:
    return "train AS (SELECT c.* FROM captions c JOIN split s USING (key) WHERE s.split = 'train')"


def vocab_cte(src: str = "train", num_words: int = 10000, marked: bool = True) -> str:
    text = mark("caption") if marked else "caption"
    return f"""
occ AS (
  SELECT key, caption_no, unnest(range(len(t))) AS pos, unnest(t) AS word
  FROM (SELECT key, caption_no, {tok(text)} AS t FROM {src})
),
occ_ranked AS (SELECT *, row_number() OVER (ORDER BY key, caption_no, pos) AS occ_no FROM occ),
counted AS (SELECT word, count(*) AS n, min(occ_no) AS first FROM occ_ranked GROUP BY word),
vocab AS (
  SELECT word, CAST(row_number() OVER (ORDER BY n DESC, first) AS INTEGER) AS id, n
  FROM counted QUALIFY row_number() OVER (ORDER BY n DESC, first) < {num_words}
)"""


def encode_cte(src: str = "train", marked: bool = True) -> str:
    text = mark("caption") if marked else "caption"
    return f"""
enc_words AS (
  SELECT key, caption_no, unnest(range(len(t))) AS pos, unnest(t) AS word
  FROM (SELECT key, caption_no, {tok(text)} AS t FROM {src})
),
enc_ids AS (
  SELECT w.key, w.caption_no, list(v.id ORDER BY w.pos) AS tokens
  FROM enc_words w JOIN vocab v USING (word) GROUP BY w.key, w.caption_no
),
encoded AS (
  SELECT s.key, s.caption_no, coalesce(e.tokens, []::INTEGER[]) AS tokens
  FROM (SELECT DISTINCT key, caption_no FROM {src}) s
  LEFT JOIN enc_ids e ON s.key = e.key AND s.caption_no = e.caption_no
)"""


def ids_text(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


def bleu_ctes(max_n: int = 4) -> str:
    """CTEs over ``hyp0(key, t)`` and ``refs(key, ref_no, t)`` ending in ``stats`` (corpus)
    and ``stats_by_key``: m1..mN, d1..dN, hyp_len, ref_len."""
    ms = ", ".join(f"CAST(sum(CASE WHEN n = {n} THEN matches ELSE 0 END) AS BIGINT) AS m{n}, "
                   f"CAST(sum(greatest(hyp_len - {n} + 1, 1)) FILTER (WHERE n = 1) AS BIGINT) AS d{n}"
                   for n in range(1, max_n + 1))
    return f"""
hyp AS (SELECT * FROM hyp0 WHERE key IN (SELECT key FROM refs)),
ns AS (SELECT unnest(range(1, {max_n + 1})) AS n),
hg AS (SELECT key, n, array_to_string(t[i:i + n - 1], ' ') AS gram
       FROM (SELECT key, n, t, unnest(range(1, len(t) - n + 2)) AS i FROM hyp CROSS JOIN ns)),
rg AS (SELECT key, ref_no, n, array_to_string(t[i:i + n - 1], ' ') AS gram
       FROM (SELECT key, ref_no, n, t, unnest(range(1, len(t) - n + 2)) AS i FROM refs CROSS JOIN ns)),
hc AS (SELECT key, n, gram, count(*) AS h FROM hg GROUP BY key, n, gram),
rc AS (SELECT key, n, gram, max(c) AS r
       FROM (SELECT key, ref_no, n, gram, count(*) AS c FROM rg GROUP BY key, ref_no, n, gram)
       GROUP BY key, n, gram),
mk AS (SELECT key, n, CAST(sum(least(h, coalesce(r, 0))) AS BIGINT) AS matches
       FROM hc LEFT JOIN rc USING (key, n, gram) GROUP BY key, n),
hl AS (SELECT key, CAST(len(t) AS INTEGER) AS hyp_len FROM hyp),
rl AS (SELECT DISTINCT key, CAST(len(t) AS INTEGER) AS rl FROM refs),
cl AS (SELECT hl.key, hl.hyp_len, arg_min(rl.rl, (abs(rl.rl - hl.hyp_len), rl.rl)) AS ref_len
       FROM hl JOIN rl USING (key) GROUP BY hl.key, hl.hyp_len),
lk AS (SELECT cl.key, ns.n, coalesce(mk.matches, 0) AS matches, cl.hyp_len, cl.ref_len
       FROM cl CROSS JOIN ns LEFT JOIN mk ON mk.key = cl.key AND mk.n = ns.n),
stats_by_key AS (SELECT key, {ms},
       CAST(sum(hyp_len) FILTER (WHERE n = 1) AS BIGINT) AS hyp_len,
       CAST(sum(ref_len) FILTER (WHERE n = 1) AS BIGINT) AS ref_len FROM lk GROUP BY key),
stats AS (SELECT {", ".join(f"CAST(coalesce(sum(m{n}), 0) AS BIGINT) AS m{n}, CAST(coalesce(sum(d{n}), 0) AS BIGINT) AS d{n}" for n in range(1, max_n + 1))},
       CAST(coalesce(sum(hyp_len), 0) AS BIGINT) AS hyp_len,
       CAST(coalesce(sum(ref_len), 0) AS BIGINT) AS ref_len FROM stats_by_key)"""


def bleu_score_expr(weights) -> str:
    logs, zero = "0.0", "false"
    for n, w in enumerate(weights, start=1):
        if w <= 0:
            continue
        zero += f" OR m{n} = 0"
        logs = f"({logs} + {float(w)!r} * ln(CAST(m{n} AS DOUBLE) / CAST(d{n} AS DOUBLE)))"
    bp = ("CASE WHEN hyp_len > ref_len THEN 1.0 WHEN hyp_len = 0 THEN 0.0 "
          "ELSE exp(1.0 - CAST(ref_len AS DOUBLE) / CAST(hyp_len AS DOUBLE)) END")
    return f"CASE WHEN {zero} OR m1 = 0 THEN 0.0 ELSE {bp} * exp({logs}) END"


def bleu_scores_select(src: str, by_key: bool = False, weights: dict | None = None) -> str:
    from tessera.operators.bleu import DEFAULT_WEIGHTS
    weights = weights or DEFAULT_WEIGHTS
    k = "key, " if by_key else ""
    parts = [f"SELECT {k}'{name}' AS metric, round({bleu_score_expr(w)}, 6) AS score FROM {src}"
             for name, w in weights.items()]
    return " UNION ALL ".join(parts)


def knn_ctes(k: int = 5) -> str:
    """Exact k-NN of held-out keys' vectors against training keys' vectors (brute force)."""
    return f"""
qv AS (SELECT vec_id AS key, embedding AS v FROM embeddings
       WHERE vec_id IN (SELECT key FROM split WHERE split = 'val') AND embedding IS NOT NULL),
bv AS (SELECT vec_id AS key, embedding AS v FROM embeddings
       WHERE vec_id IN (SELECT key FROM split WHERE split = 'train') AND embedding IS NOT NULL),
sims AS (SELECT qv.key AS query, bv.key AS neighbour,
                round(list_dot_product(qv.v::DOUBLE[], bv.v::DOUBLE[]), 6) AS sim
         FROM qv CROSS JOIN bv),
knn AS (SELECT query, neighbour, sim, CAST(rank AS INTEGER) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY query ORDER BY sim DESC, neighbour) AS rank FROM sims)
        WHERE rank <= {k})"""


def retrieve_ctes() -> str:
    """Consensus caption among the neighbours' training captions; needs ``knn`` and ``train``."""
    return f"""
cand AS (SELECT knn.query, t.key, t.caption_no, t.caption FROM knn JOIN train t ON t.key = knn.neighbour),
cwords AS (SELECT DISTINCT query, key, caption_no, unnest(list_distinct({tok('caption')})) AS w FROM cand),
dfq AS (SELECT query, w, count(*) AS df FROM cwords GROUP BY query, w),
per AS (SELECT cw.query, cw.key, cw.caption_no, sum(d.df - 1) AS s, count(*) AS u
        FROM cwords cw JOIN dfq d USING (query, w) GROUP BY cw.query, cw.key, cw.caption_no),
nq AS (SELECT query, count(*) AS n_cand FROM cand GROUP BY query),
scored AS (SELECT c.query, c.key, c.caption_no, c.caption,
                  CASE WHEN nq.n_cand > 1 AND coalesce(p.u, 0) > 0
                       THEN CAST(p.s AS DOUBLE) / (p.u * (nq.n_cand - 1)) ELSE 0.0 END AS score
           FROM cand c JOIN nq USING (query)
           LEFT JOIN per p ON p.query = c.query AND p.key = c.key AND p.caption_no = c.caption_no),
best AS (SELECT query, key, caption_no, caption, score FROM (
           SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, key, caption_no) AS rn
           FROM scored) WHERE rn = 1)"""


def corpus_model_ctes() -> str:
    """Needs ``vocab`` and ``encoded``: marker ids, bigram counts ``bigr`` and argmax ``corp``."""
    return """
ids AS (SELECT max(CASE WHEN word = 'ssss' THEN id END) AS s_id,
               max(CASE WHEN word = 'eeee' THEN id END) AS e_id FROM vocab),
bigr AS (SELECT t[i] AS c1, t[i + 1] AS nxt, count(*) AS cnt
         FROM (SELECT tokens AS t, unnest(range(1, len(tokens))) AS i FROM encoded) GROUP BY ALL),
corp AS (SELECT c1, CAST(arg_max(nxt, (cnt, -nxt)) AS INTEGER) AS nxt FROM bigr GROUP BY c1)"""


def neighbour_model_ctes() -> str:
    """Needs ``knn`` and ``encoded``: similarity-weighted argmax tables ``tri`` and ``bi``."""
    return """
src AS (SELECT k.query, greatest(k.sim, 0.0) AS w, e.tokens AS t FROM knn k JOIN encoded e ON e.key = k.neighbour),
tri_s AS (SELECT query, t[i] AS c2, t[i + 1] AS c1, t[i + 2] AS nxt, round(sum(w), 6) AS score
          FROM (SELECT query, w, t, unnest(range(1, len(t) - 1)) AS i FROM src) GROUP BY ALL),
tri AS (SELECT query, c2, c1, CAST(arg_max(nxt, (score, -nxt)) AS INTEGER) AS nxt FROM tri_s GROUP BY ALL),
bi_s AS (SELECT query, t[i] AS c1, t[i + 1] AS nxt, round(sum(w), 6) AS score
         FROM (SELECT query, w, t, unnest(range(1, len(t))) AS i FROM src) GROUP BY ALL),
bi AS (SELECT query, c1, CAST(arg_max(nxt, (score, -nxt)) AS INTEGER) AS nxt FROM bi_s GROUP BY ALL)"""


def decode_ctes(queries: str, max_tokens: int, neighbours: bool) -> str:
    """Recursive greedy decode over ``corp`` (and ``tri``/``bi``); ends in ``decoded``."""
    if neighbours:
        nx = "coalesce(t.nxt, b.nxt, c.nxt)"
        joins = ("LEFT JOIN tri t ON t.query = d.query AND t.c2 = d.c2 AND t.c1 = d.c1 "
                 "LEFT JOIN bi b ON b.query = d.query AND b.c1 = d.c1 ")
    else:
        nx, joins = "c.nxt", ""
    return f"""
dec(query, step, c2, c1, out, done) AS (
  SELECT q.query, 0, CAST(NULL AS INTEGER), CAST(ids.s_id AS INTEGER), []::INTEGER[], false
  FROM {queries} q CROSS JOIN ids
  UNION ALL
  SELECT d.query, d.step + 1, d.c1, {nx},
         CASE WHEN {nx} IS NULL THEN d.out ELSE list_append(d.out, {nx}) END,
         {nx} IS NULL OR {nx} = ids.e_id OR d.step + 1 >= {max_tokens}
  FROM dec d CROSS JOIN ids {joins}
  LEFT JOIN corp c ON c.c1 = d.c1
  WHERE NOT d.done
),
fin AS (SELECT query, out FROM dec WHERE done),
dwords AS (SELECT f.query, unnest(range(len(f.out))) AS pos, unnest(f.out) AS tid FROM fin f),
dtext AS (SELECT d.query, string_agg(v.word, ' ' ORDER BY d.pos) AS text
          FROM dwords d CROSS JOIN ids JOIN vocab v ON v.id = d.tid
          WHERE d.tid <> ids.s_id AND d.tid <> ids.e_id GROUP BY d.query),
decoded AS (SELECT f.query, f.out, coalesce(t.text, '') AS text FROM fin f LEFT JOIN dtext t USING (query))"""


def decoded_select() -> str:
    return ("SELECT query, CAST(len(out) AS INTEGER) AS n_tokens, array_to_string(out, ' ') AS tokens, text "
            "FROM decoded")
