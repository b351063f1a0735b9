import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import TEXTS, documents, edge_docs, no_docs, prose
from pyspark.sql import functions as F

from tessera.llm import queries, simhash
from tessera.llm.components import components

from conftest import SF001


def fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")) if x]
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(parts))


def classes(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_pairs(values, limit=3):
    v = np.array(values, np.uint64)
    return [(values[i], values[int(j) + i + 1]) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= limit)]


def expected(rows):
    """(doc_id, fingerprint, component_id) of rows (doc_id, text)."""
    prints = [(i, fingerprint(t)) for i, t in rows]
    distinct = sorted({f for _, f in prints})
    of = classes(distinct, near_pairs(distinct))
    least = defaultdict(list)
    for i, f in prints:
        if i is not None:
            least[of[f]].append(i)
    return Counter((i, f"{f:016x}", min(least[of[f]], default=None)) for i, f in prints)


def test_edge_rows(spark):
    found = simhash.near_groups(edge_docs(spark)).select("doc_id", simhash.unsigned_hex(F.col("fp")), "component_id")
    assert Counter(map(tuple, found.collect())) == expected(TEXTS)
    assert simhash.near_groups(no_docs(spark)).collect() == []


def test_whole_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(SF001).itertuples()]
    assert Counter(map(tuple, queries.op9_simhash(spark, SF001).collect())) == expected(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("a b C dé \t \n Z z".split(" ")), max_size=300))
def test_fingerprint(words):
    assert simhash.fingerprint(" ".join(words)) == fingerprint(" ".join(words))


def cluster(n, seed, flips):
    rng = np.random.default_rng(seed)
    out = set()
    for base in rng.integers(0, 1 << 63, n).tolist():
        out.add(base)
        for _ in range(int(rng.integers(0, 6))):
            x = base
            for b in rng.choice(64, int(rng.integers(1, flips)), replace=False).tolist():
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("limit", [1, 3])
def test_index_finds_each_near_pair_once(limit):
    values = np.array(cluster(200, 1, 6), np.uint64)
    for group in (np.zeros(len(values), int), np.sort(np.random.default_rng(2).integers(0, 30, len(values)))):
        index, got = simhash.GrayIndex(values, group, limit), Counter()
        dealt = group[np.lexsort((simhash.gray_rank(values), group))]
        for a, b in index.links():
            got.update(zip(a.tolist(), b.tolist(), strict=True))
        v = index.values
        want = [(i, int(j)) for i in range(len(v)) for j in range(i + 1, len(v)) if dealt[i] == dealt[j] and int(v[i] ^ v[j]).bit_count() <= limit]
        assert got == Counter(want)


@pytest.mark.parametrize("size", [2048, 8, 2])
def test_groups_lose_no_link_when_large_ones_are_dealt_again(spark, size):
    hot = [i | 0xABCD << 48 for i in range(400)]  # agree on one quarter and most other bits
    values = sorted({*cluster(60, 3, 5), *hot, 0, 1, (1 << 64) - 1})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    groups = simhash.groups(spark.createDataFrame([(x,) for x in signed], "fp long"), size=size)
    found = set()
    for r in groups.collect():
        m = np.array(r.members, np.int64).view(np.uint64)
        found.update((min(a, b), max(a, b)) for a, b in near_pairs(m.tolist()))
    assert found == set(near_pairs(values))


def test_components_of_chains_stars_and_cliques(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)] + [(2000 + i, 2000 + j) for i in range(20) for j in range(i)] + [(5000, 4999), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == classes({x for e in edges for x in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_dropping_keeps_columns_and_one_row_of_each_component(spark):
    text = prose(300, 9)
    rows = [(i, text if i < 5 else prose(50, i), "x") for i in range(3, 12)] + [(3, text, "x"), (None, prose(40, 77), "x"), (None, prose(40, 77), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter([3, 5, 6, 7, 8, 9, 10, 11, None])
    edge = simhash.drop_near_duplicates(edge_docs(spark))
    stays = {(i, c) for i, _, c in expected(TEXTS) if i == c}
    assert Counter(r.doc_id for r in edge.collect()) == Counter(i for i, _ in stays)
    assert simhash.drop_near_duplicates(no_docs(spark)).collect() == []
