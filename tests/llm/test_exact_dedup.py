import hashlib
import re
from collections import Counter, defaultdict

import pytest
from llm_cases import TEXTS, documents, edge_docs, no_docs

from tessera.llm import exact_dedup, queries

from conftest import SF001


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out, taken = [], set()
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = min(ids, default=None)
        first = i == keep and norm(t) not in taken
        if first:
            taken.add(norm(t))
        out.append((i, keep, len(groups[norm(t)]), first, hashlib.sha256(norm(t).encode()).hexdigest()))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.full_hash.hex()) for r in df.collect())


@pytest.mark.parametrize("bits", [4, 16])
def test_edge_rows(spark, bits):
    assert got(exact_dedup.exact_groups(edge_docs(spark), bits=bits, digest=True)) == expected(TEXTS)


def test_whole_table_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in documents(SF001).itertuples()]
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in queries.op2_exact_dedup(spark, SF001).collect())
    assert found == expected(rows)


def test_full_hash_is_read_for_survivors_only(spark):
    rows = exact_dedup.refine(edge_docs(spark)).collect()
    assert all((r.full_hash is not None) == r.survivor for r in rows)
    assert not next(r for r in rows if r.doc_id == 7).survivor


def test_dropping_keeps_columns_and_one_row_of_each_text(spark):
    docs = edge_docs(spark)
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter(norm(r.text) for r in left.collect()) == Counter({norm(t) for _, t in TEXTS})
    assert exact_dedup.drop_exact_duplicates(no_docs(spark)).collect() == []


def test_empty_table(spark):
    assert exact_dedup.exact_groups(no_docs(spark)).collect() == []


def test_main_path_has_no_python(spark):
    plan = exact_dedup.exact_groups(edge_docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_dropping_duplicates_hashes_only_survivors_for_the_groups(spark, monkeypatch):
    asked, refine = [], exact_dedup.refine
    monkeypatch.setattr(exact_dedup, "refine", lambda docs, i, t, bits, digest=False: asked.append(digest) or refine(docs, i, t, bits, digest))
    docs = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "c")], "doc_id long, text string")
    assert {r.doc_id for r in exact_dedup.drop_exact_duplicates(docs).collect()} == {1, 3} and asked == [False]
