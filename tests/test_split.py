import hashlib

from pyspark.sql import functions as F

from tessera.operators import split as S
from tessera.operators.indexing import dense_index, rank_within
from tessera.sources import tables

from conftest import SF01


def test_split_disjoint_and_covering(spark):
    c = tables.captions(spark, SF01)
    sp = S.split_by_key(c)
    per_key = sp.groupBy("key").agg(F.countDistinct("split").alias("k"))
    assert per_key.filter("k > 1").count() == 0
    chk = {r["check"]: r["n"] for r in S.check_split(sp.filter("split='train'"), sp.filter("split='val'"), c).collect()}
    assert chk["overlap"] == 0 and chk["uncovered"] == 0 and chk["extra"] == 0
    held = [k for k in range(100) if int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:15], 16) < 0.2 * 2 ** 60]
    assert chk["n_val"] == len(held) > 0 and chk["n_train"] == 100 - len(held)


def test_split_check_counts_each_fault(spark):
    def keys(*k):
        return spark.createDataFrame([(x,) for x in (*k, *k[:1])], "key long")
    chk = {r["check"]: r["n"] for r in S.check_split(keys(1, 2, 3, 9), keys(3, 4), keys(1, 2, 3, 4, 5, 6)).collect()}
    assert chk == {"overlap": 1, "uncovered": 2, "extra": 1, "n_train": 4, "n_val": 2}


def test_small_shares_are_not_rounded_away(spark):
    df = spark.range(200_000).withColumnRenamed("id", "key")
    held = S.split_rows(df, "val", test=0.00004).count()
    assert 0 < held < 40
    assert df.select(F.max(S.seeded_hash(1, "key"))).first()[0] > 2 ** 59


def test_split_independent_of_partitioning(spark):
    c = tables.captions(spark, SF01)
    a = sorted(S.split_keys(c.repartition(1)).collect())
    b = sorted(S.split_keys(c.repartition(37)).collect())
    assert a == b


def test_exact_split_size(spark):
    c = tables.captions(spark, SF01)
    keys = S.split_keys(c, exact=True)
    assert keys.filter("split = 'val'").count() == 20


def test_dense_index_is_a_permutation(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(13)
    idx = dense_index(df, ["v"], "i").collect()
    assert sorted((r["v"], r["i"]) for r in idx) == [(v, v) for v in range(1000)]


def test_rank_within_skewed_key(spark):
    # one key owns most rows
    rows = [(0, i) for i in range(500)] + [(k, i) for k in range(1, 20) for i in range(3)]
    df = spark.createDataFrame(rows, "key bigint, o bigint").repartition(7)
    got = rank_within(df, "key", ["o"], "r").collect()
    assert all(r["r"] == r["o"] for r in got)


def test_sample_keys_seeded(spark):
    c = tables.captions(spark, SF01)
    a = [r["key"] for r in S.sample_keys(c, 10, 3).collect()]
    b = [r["key"] for r in S.sample_keys(c.repartition(5), 10, 3).collect()]
    assert a == b and len(set(a)) == 10


def test_split_side_is_a_narrow_filter_equal_to_the_semi_join(spark):
    from tessera.plans.evaluate import caption_side
    from tessera.sources import tables
    from conftest import SF01
    c = tables.table(spark, SF01, "conversations").selectExpr("conv_id AS key", "turn AS caption_no",
                                                              "text AS caption")
    side = caption_side(c, "val")
    assert "Exchange" not in side._jdf.queryExecution().executedPlan().toString()
    keys = S.split_keys(c).filter("split = 'val'")
    assert sorted(map(tuple, side.collect())) == sorted(map(tuple, S.select_split(c, keys).collect()))


def test_rank_within_carries_keys_over_partitions(spark):
    from pyspark.sql import functions as F
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        # one key with a third of the rows, keys of one row, a null key, and long runs that fill partitions
        rows = [("hot", i) for i in range(2000)] + [(f"k{i:04}", 0) for i in range(2000)] + [(None, i) for i in range(1000)] + [("z", i) for i in range(1000)]
        df = spark.createDataFrame(rows, "key string, o bigint").repartition(9, "o")
        for n in (3, 8, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            out = rank_within(df, "key", ["o"], "r")
            assert sorted(map(tuple, out.select("key", "o", "r").collect()), key=repr) == sorted([(k, o, o) for k, o in rows], key=repr)
            p = out._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in p and "SortMergeJoin" not in p
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert rank_within(df.limit(0), "key", ["o"], "r").collect() == []


def test_kth_smallest(spark):
    import numpy as np
    for values in (np.random.default_rng(1).integers(0, 1 << 60, 20_000).tolist(), [5] * 6000 + [4, 6], list(range(9000)), [(1 << 60) - 1]):
        df = spark.createDataFrame([(v,) for v in values], "v bigint")
        ordered = sorted(values)
        for k in {1, len(values) // 3 + 1, len(values)}:
            cut = ordered[k - 1]
            assert S.kth_smallest(df, "v", k) == (cut, ordered.index(cut))
        assert S.kth_smallest(df, "v", len(values) + 1) is None


def test_exact_split_is_a_filter_without_a_sort(spark):
    rows = spark.range(30_000).selectExpr("CAST(id % 7001 AS string) AS key", "id").unionAll(spark.sql("SELECT CAST(NULL AS string), -1L"))
    for test in (0.0, 0.2, 1.0):
        out = S.split_by_key(rows, "key", test=test, exact=True)
        p = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in p and "Sort" not in p and "Join" not in p
        held = {r["key"] for r in out.filter("split = 'val'").collect()}
        assert len(held) == -(-7001 * int(10 * test) // 10)
        assert held.isdisjoint({r["key"] for r in out.filter("split = 'train'").collect()})


def test_exact_split_tells_equal_hashes_apart(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(S, "seeded_hash", lambda seed, *c: (F.col(c[0]) % 3).cast("long"))
    out = S.split_by_key(spark.range(100).withColumnRenamed("id", "key"), "key", test=0.5, exact=True)
    held = sorted(r["key"] for r in out.filter("split = 'val'").collect())
    assert held == sorted(sorted(range(100), key=lambda k: (k % 3, k))[:50])
