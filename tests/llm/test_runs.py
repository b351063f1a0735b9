import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import TEXTS, ascii_words, documents, edge_docs, no_docs

from conftest import SF001

from tessera.llm import queries, runs


def brute(w, min_length=12, min_periods=2):
    """(start, length, period) of every run, by a scan for each period."""
    out = {}
    for q in range(1, len(w) // min_periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_periods * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def found_in(docs, min_length=12, min_periods=2):
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    ids = np.array([x for d in docs for x in d], np.int64)
    out = [[] for _ in docs]
    for s, e, q in runs.slice_runs(ids, first, min_length, min_periods).T.tolist():
        k = int(np.searchsorted(first, s, "right")) - 1
        out[k].append((s - int(first[k]), e - s, q))
    return out


block = st.lists(st.integers(0, 4), min_size=1, max_size=9)
text = st.lists(st.tuples(block, st.integers(1, 7)), max_size=8).map(lambda x: [w for b, n in x for w in b * n])


@settings(max_examples=150, deadline=None)
@given(st.lists(text, min_size=1, max_size=4), st.sampled_from([(12, 2), (12, 3), (5, 2), (2, 2), (20, 4)]))
def test_runs_against_brute_force(docs, limits):
    assert found_in(docs, *limits) == [brute(d, *limits) for d in docs]


def test_fibonacci_words_and_one_word():
    a, b = [0], [0, 1]
    for _ in range(12):
        a, b = b, b + a
    docs = [b, [7] * 300, list(range(40)) * 9, [7] * 11, [7] * 12, list(range(6)) * 2, list(range(7)) * 2 + [9], []]
    assert found_in(docs) == [brute(d) for d in docs]


def test_re_pair_leaves_no_pair_twice_and_derives_the_text():
    rng = np.random.default_rng(5)
    for n in (0, 1, 30, 400):
        seq = rng.integers(0, 5, n).tolist()
        left, places, rules = runs.repair(seq, 100)

        def derive(s):
            return [s] if s < 100 else derive(rules[s - 100][0]) + derive(rules[s - 100][1])

        assert [x for s in left for x in derive(s)] == seq and places == sorted(places)
        pairs = list(zip(left, left[1:]))
        assert all(sum(p == q and abs(i - j) != 1 for j, q in enumerate(pairs)) <= 1 for i, p in enumerate(pairs))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def rows_of(df):
    return sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()], key=repr)


def test_edge_rows(spark):
    want = []
    for i, t in TEXTS:
        w = ascii_words(t)
        found = brute(w) if len(w) < 5000 else []
        want.append((i, len(w), found, collapsed(w, found)))
    assert rows_of(runs.find_runs(edge_docs(spark))) == sorted(want, key=repr)
    assert runs.find_runs(no_docs(spark)).collect() == []


def test_long_periodic_document_and_equal_rows(spark):
    u = [f"w{i % 97}" for i in range(500)] + [f"v{i}" for i in range(50)]
    long = " ".join(u * 120)
    rows = [(1, long), (1, long), (2, "\n".join(["a b c"] * 5)), (None, "x " * 20)]
    got = rows_of(runs.find_runs(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got[0] == got[1] and (0, 66_000, 550) in got[0][2]
    assert {r[0]: (r[2], r[3]) for r in got[2:]} == {2: ([(0, 15, 3)], "a b c"), None: ([(0, 20, 1)], "x")}


def expected(doc_id, t):
    w = ascii_words(t)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *tail, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(w, found)))


def test_whole_table_against_brute_force(spark):
    want = sorted(expected(r.doc_id, r.text) for r in documents(SF001).itertuples())
    got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
           for r in queries.op11_runs(spark, SF001).collect()]
    assert sorted(got) == want and sum(r[1] for r in want) > 10


def test_limits_are_checked(spark):
    with pytest.raises(ValueError):
        runs.find_runs(no_docs(spark), min_periods=1)
