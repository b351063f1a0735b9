from collections import Counter

import numpy as np
import zlib
from llm_cases import TEXTS, documents, edge_docs, no_docs

from tessera.llm import queries, sharding

from conftest import SF01


def check(rows, texts):
    """rows: (doc_id, size, crc, shard, slot)."""
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter(r[:3] for r in rows) == want
    total, largest = sum(r[1] for r in rows), max(r[1] for r in rows)
    for s in range(16):
        mine = [r for r in rows if r[3] == s]
        assert sorted(r[4] for r in mine) == list(range(len(mine)))
        assert abs(sum(r[1] for r in mine) - total / 16) <= largest
    assert all(0 <= r[3] < 16 for r in rows)


def take(df):
    return [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in df.collect()]


def test_edge_rows(spark):
    check(take(sharding.shard(edge_docs(spark))), TEXTS)
    assert sharding.shard(no_docs(spark)).collect() == []


def test_whole_table(spark):
    rows = queries.op4_sharding(spark, SF01).collect()
    check([(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in rows], [(r.doc_id, r.text) for r in documents(SF01).itertuples()])
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_a_hot_text_is_spread_and_overfull_ranges_are_subdivided(spark):
    rows = [(i, "copy " * 20) for i in range(3000)] + [(i, f"text {i}") for i in range(3000, 4000)] + [(9, "repeated row")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shard(docs).collect()
    check([(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found], rows)
    per_range = Counter()
    for r in found:
        per_range[r.range_id] += r.size
    total = sum(per_range.values())
    assert max(per_range.values()) <= total / (16 * sharding.RANGES_PER_SHARD) * sharding.OVERFULL + 101


def test_equal_texts_lie_side_by_side(spark):
    rows = [(i, f"text {i % 50}") for i in range(1000)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    shards = {}
    for r in found:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert np.mean([len(s) for s in shards.values()]) < 1.5
