import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import TEXTS, documents, edge_docs, no_docs

from conftest import SF001

from tessera.llm import collocations as C


def pieces(text):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for p in re.split(r"[.,;:!?\x0A-\x0D]", t) if (w := re.findall(r"[^\x20\x09]+", p))]


def counted(rows, max_words=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for w in pieces(text):
            lang = "und" if lang is None else lang
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, min_count=100, max_words=5, top=2000, cover=100):
    f, totals = counted(rows, max_words)
    out = []
    for lang, c in f.items():
        n, left = totals[lang], []
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        covered = defaultdict(int)
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covered[p[i:i + k]] = max(covered[p[i:i + k]], a)
        for p, a in cand.items():
            if 100 * covered[p] >= cover * a:
                continue
            score, k = min((1000 * a * n // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            left.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, lo, r) in enumerate(sorted(left)[:top], 1):
            out.append((lang, rank, p.decode(), -a, lo, r, n, -score))
    return sorted(out)


def got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


SCHEMA = "doc_id long, text string, lang string, phrase string, n long, word string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "clash", None, "clash") for i, (lang, t) in enumerate(rows)], SCHEMA)


def zipf_rows(n, seed=1, vocabulary=60):
    rng = np.random.default_rng(seed)
    marks = [" ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "! "]
    rows = []
    for i in range(n):
        words = np.minimum(rng.zipf(1.4, 80), vocabulary)
        rows.append(([None, "en", "und", "fr"][i % 4], "".join(f"{'W' if x % 2 else 'é'}{x}{marks[rng.integers(len(marks))]}" for x in words)))
    return rows


@pytest.mark.parametrize("min_count,max_words,top,cover,max_group", [(5, 5, 2000, 100, 200_000), (3, 5, 50, 80, 20), (2, 3, 2000, 100, 5), (4, 2, 10, 100, 1), (1, 4, 300, 60, 40)])
def test_against_brute_force(spark, min_count, max_words, top, cover, max_group):
    rows = zipf_rows(60, min_count)
    docs = table(spark, rows)
    assert got(C.collocations(docs, min_count, max_words, top, cover, max_group)) == brute(rows, min_count, max_words, top, cover)


def test_a_third_of_all_words_under_one_pair(spark):
    rng = np.random.default_rng(2)
    rows = [("en", " ".join(f"of the x{rng.integers(9)} y{rng.integers(4)}" for _ in range(30))) for _ in range(40)] + zipf_rows(40)
    docs = table(spark, rows)
    for group in (3, 10, 200_000):
        assert got(C.collocations(docs, 5, max_group=group)) == brute(rows, 5)
    counts = {(r.lang, r.phrase): r.n for r in C.phrase_counts(docs, 5, max_group=3).filter("n_words > 1").collect()}
    f, _ = counted(rows)
    assert counts == {(lang, " ".join(p)): a for lang, c in f.items() for p, a in c.items() if len(p) > 1 and a >= 5}


def test_edge_rows(spark):
    rows = [(t[0] and "x", t[1]) for t in TEXTS]
    docs = spark.createDataFrame([(i, t, lang, None, None, None) for i, (lang, t) in enumerate(rows)], SCHEMA)
    assert got(C.collocations(docs, 2)) == brute(rows, 2)
    assert C.collocations(no_docs(spark)).collect() == []
    found = got(C.collocations(edge_docs(spark), 20))
    assert found == brute([(None, t) for _, t in TEXTS], 20)


def test_whole_table_against_brute_force(spark):
    rows = [(r.lang, r.text) for r in documents(SF001).itertuples()]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert got(C.collocations(docs, 6)) == brute(rows, 6)


def test_without_filters_the_joins_decide(spark, monkeypatch):
    monkeypatch.setattr(C, "key_filter", lambda *a: None)
    rows = zipf_rows(30)
    assert got(C.collocations(table(spark, rows), 4)) == brute(rows, 4)


def test_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(C, "KEEP", 50)
    monkeypatch.setattr(C, "KEEP_WORDS", 20)
    rows = zipf_rows(400)
    assert got(C.collocations(table(spark, rows).repartition(2), 9, max_group=30)) == brute(rows, 9)


def test_quicksort_counts_equal_partitions():
    rng = np.random.default_rng(4)
    columns = rng.integers(0, 4, (3, 500))
    columns[2][rng.random(500) < 0.3] = -1
    weights = rng.integers(1, 4, 500)
    found = {(tuple(columns[:d + 1, r].tolist())): t for r, d, t in C.multikey_quicksort(columns, weights, 25)}
    want = Counter()
    for row, w in zip(columns.T.tolist(), weights.tolist()):
        for d in range(1, 4):
            if row[d - 1] >= 0:
                want[tuple(row[:d])] += w
    assert found == {k: v for k, v in want.items() if v >= 25}
