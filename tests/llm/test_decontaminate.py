import math
import re
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import TEXTS, documents, edge_docs, no_docs, prose

from tessera.llm import decontaminate, members

ITEMS = "item_id long, text string, doc_id string, uid string"
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return LETTERS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def windows(items, size=10):
    out = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            out[tuple(w[i:i + n])].add("" if item is None else str(item))
    return out


def brute(docs, items, size=10, shingle=3, share=1.0):
    known, out = windows(items, size), []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for g, owners in known.items():
            k = min(shingle, len(g))
            m = len(g) - k + 1
            for i in range(len(w) - len(g) + 1):
                if share == 1:
                    same = tuple(w[i:i + len(g)]) == g
                else:
                    same = sum(tuple(w[i + j:i + j + k]) == g[j:j + k] for j in range(m)) >= math.ceil(m * share)
                if same:
                    hit.update(range(i, i + len(g)))
                    found |= owners
        out.append((doc, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()], key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], ITEMS)


ROWS = [(1, prose(30, 1)), (2, prose(10, 5)), (3, None), (4, ""), (5, "One."), (6, "two words"), (2, prose(12, 6)), (None, prose(11, 7)), (7, prose(30, 1)),
        (8, "  ... "), (9, "ñandú 你好 🙂 endoftext")]


@pytest.fixture(scope="module")
def edge_items(spark):
    return items_of(spark, ROWS)


def test_edge_rows(spark, edge_items):
    assert got(decontaminate.contamination(edge_docs(spark), edge_items)) == brute(TEXTS, ROWS)
    assert decontaminate.contamination(no_docs(spark), edge_items).collect() == []
    clean = got(decontaminate.contamination(edge_docs(spark), items_of(spark, [(1, None)]).limit(0)))
    assert clean == brute(TEXTS, [])


def test_passages_of_many_shapes(spark, edge_items):
    p = prose(30, 1).split()
    rows = [(i, f"{prose(20, 50 + i)} {' '.join(p[i % 20:i % 20 + 9 + i % 4]).upper()}, {prose(15, 90 + i)}") for i in range(40)]
    rows += [(100, " ".join(p * 3)), (101, " ".join(p[:10] + p[:10])), (102, " ".join(p[5:14])), (103, "one two words ONE"), (104, "two. words"), (105, prose(10, 5))]
    rows += [(200 + i, " ".join(p)) for i in range(200)]  # a hot passage
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.contamination(docs, edge_items)
    assert got(found) == brute(rows, ROWS)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in found.collect()}
    assert spans[105] == [(0, 10)] and spans[104] == [(0, 2)] and spans[102] == []
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, edge_items).collect()}
    assert kept == {r[0] for r in brute(rows, ROWS) if not r[2]}
    held = {r["item"]: r.n_docs for r in decontaminate.contaminated_share(found).collect()}
    assert held["1"] == sum("1" in r[3] for r in brute(rows, ROWS))


@pytest.mark.parametrize("size,shingle,share", [(6, 2, 1.0), (10, 3, 0.75), (8, 1, 0.7), (4, 5, 1.0), (10, 3, 0.3)])
def test_other_parameters(spark, size, shingle, share):
    rng = np.random.default_rng(3)
    items = [(i, prose(14, 300 + i)) for i in range(6)] + [(6, "mon dan")]
    rows = []
    for i in range(60):
        w = items[i % 6][1].split()[i % 3:i % 3 + 12]
        for _ in range(i % 4):
            w[rng.integers(len(w))] = "other"
        rows.append((i, f"{prose(5, i)} {' '.join(w)} {prose(5, 900 + i)}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.contamination(docs, items_of(spark, items), size, shingle, share)
    assert got(found) == brute(rows, items, size, shingle, share)


def test_whole_table_against_brute_force(spark):
    from conftest import SF001
    import pandas as pd
    from tessera.llm import queries

    docs = [(r.doc_id, r.text) for r in documents(SF001).itertuples()]
    items = [(r.item_id, r.text) for r in pd.read_parquet(f"{SF001}/benchmark.parquet").itertuples()]
    known, want = windows(items), {}
    for doc, text in docs:  # every window holds 10 words or is short: look windows up by their words
        w, hit = words(text), set()
        for n in {len(g) for g in known}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in known:
                    hit.update(range(i, i + n))
        want[doc] = (len(w), len(hit))
    found = {r.doc_id: (r.n_words, r.n_hit) for r in queries.op13_decontaminate(spark, SF001).collect()}
    assert found == want and any(n for _, n in want.values())


def test_filter_lets_keys_through_and_few_others(spark):
    keys = spark.range(50_000).selectExpr("xxhash64(id) AS key")
    bits = members.key_filter(keys, "key")
    own = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
    other = np.random.default_rng(1).integers(0, 2 ** 63, 100_000).astype(np.uint64)
    assert members.holds(bits, own).all() and members.holds(bits, other).mean() < 0.01
    assert members.key_filter(keys, "key", max_bits=18) is None and members.holds(None, own).all()


def test_without_a_filter_the_joins_decide(spark, edge_items, monkeypatch):
    monkeypatch.setattr(decontaminate, "key_filter", lambda *a: None)
    assert got(decontaminate.contamination(edge_docs(spark), edge_items)) == brute(TEXTS, ROWS)
