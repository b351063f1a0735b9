from pyspark.sql import functions as F

from tessera.operators import batches as B
from tessera.operators import vocab as V
from tessera.plans import registry as REG
from tessera.sources import tables

from conftest import SF01


def encoded(spark):
    tr = REG._train(spark, SF01)
    return V.encode(tr, REG._vocab(spark, SF01))


def test_batch_invariants(spark):
    b = B.draw_batches(encoded(spark), tables.features(spark, SF01), 64, steps=3, seed=5).collect()
    assert len(b) == 192
    by_batch = {}
    for r in b:
        assert len(r["x"]) == len(r["y"])
        assert r["x"][1:] == r["y"][:-1]
        assert len(r["features"]) == 64
        by_batch.setdefault(r["batch_id"], set()).add(len(r["x"]))
    assert all(len(s) == 1 for s in by_batch.values())   # padded to the batch maximum
    assert sorted(by_batch) == [0, 1, 2]


def test_batches_same_for_any_partitioning(spark):
    e = encoded(spark)
    a = B.draw_batches(e.repartition(1), None, 32, steps=2, seed=9)
    b = B.draw_batches(e.repartition(50), None, 32, steps=2, seed=9)
    cols = ["batch_id", "slot", "key", "caption_no", "x", "y"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_seed_changes_draws(spark):
    e = encoded(spark)
    a = B.draw_batches(e, None, 32, steps=1, seed=1).select("key").collect()
    b = B.draw_batches(e, None, 32, steps=1, seed=2).select("key").collect()
    assert a != b


def test_random_caption_one_per_key(spark):
    c = tables.captions(spark, SF01)
    r = B.random_caption(c, 3)
    assert r.count() == c.select("key").distinct().count()
    assert r.groupBy("key").count().filter("count > 1").count() == 0


def test_group_and_flatten_round_trip(spark):
    c = tables.captions(spark, SF01)
    g = B.group_captions(c)
    f = B.flatten_captions(g)
    renum = c.select("key", "caption", F.row_number().over(
        __import__("pyspark.sql").sql.Window.partitionBy("key").orderBy("caption_no")).alias("n"))
    assert f.count() == c.count()
    assert sorted((r["key"], r["caption_no"] + 1, r["caption"]) for r in f.collect()) == \
        sorted((r["key"], r["n"], r["caption"]) for r in renum.collect())


def test_steps_per_epoch_truncates(spark):
    df = spark.range(1000).select(F.col("id").alias("key"))
    assert B.steps_per_epoch(df, 384).first()["steps"] == 2


def test_groups_come_in_pages_of_bounded_size(spark):
    rows = spark.range(1_000_000).selectExpr("0L AS key", "id AS caption_no", "concat('c', id) AS caption")
    rest = spark.createDataFrame([(1, 0, "a"), (1, 1, None), (2, 0, "b"), (None, 0, "n")], "key bigint, caption_no bigint, caption string")
    got = B.group_captions(rows.unionByName(rest), page_rows=10_000)
    sizes = {(r["key"], r["page"]): r["n"] for r in got.selectExpr("key", "page", "size(captions) AS n").collect()}
    assert sizes == {**{(0, p): 10_000 for p in range(100)}, (1, 0): 2, (2, 0): 1, (None, 0): 1}
    flat = B.flatten_captions(got)
    assert flat.filter("key = 0 AND caption <> concat('c', caption_no)").isEmpty() and flat.count() == 1_000_004
    assert sorted(map(tuple, flat.filter("key <> 0 OR key IS NULL").collect()), key=repr) == sorted(map(tuple, rest.collect()), key=repr)


def test_random_caption_neither_sorts_nor_gathers(spark):
    df = spark.createDataFrame([(k, i, f"t{k}{i}") for k in range(20) for i in range(9)] + [(3, 1, "t31")] * 3 + [(3, 1, "other")] + [(None, 0, "n")],
                               "key bigint, caption_no bigint, caption string")
    out = B.random_caption(df, 7)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p
    rows = out.collect()
    assert sorted([r["key"] for r in rows], key=repr) == sorted([*range(20), None], key=repr)
    assert out.exceptAll(df).isEmpty() and sorted(map(tuple, B.random_caption(df.repartition(5), 7).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
