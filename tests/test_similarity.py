import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tessera.operators import similarity as SIM


def test_knn_matches_brute_force_across_blocks(spark):
    rng = np.random.default_rng(0)
    q = rng.normal(size=(37, 8)).round(3)
    b = rng.normal(size=(91, 8)).round(3)
    b[5] = b[6]                                   # exact tie: lower id must win
    qdf = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(q)], "key bigint, features array<float>")
    bdf = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(b)], "key bigint, features array<float>")
    got = SIM.nearest(qdf, bdf, k=4, block_rows=10).collect()
    qf = q.astype(np.float32).astype(np.float64)
    bf = b.astype(np.float32).astype(np.float64)
    sims = np.round(qf @ bf.T, 6)
    want = set()
    for i in range(len(q)):
        order = sorted(range(len(b)), key=lambda j: (-sims[i, j], j))[:4]
        for rank, j in enumerate(order, 1):
            want.add((i, j, rank))
    assert {(r["query"], r["neighbour"], r["rank"]) for r in got} == want


def _vectors(spark, v, first=0):
    return spark.createDataFrame([(first + i, x.tolist()) for i, x in enumerate(v)], "key bigint, features array<float>")


def _brute(q, b, k, first=0, same=False):
    """(query, neighbour, sim, rank) with the lowest id first among equal similarities."""
    sims = np.round(q.astype(np.float32).astype(np.float64) @ b.astype(np.float32).astype(np.float64).T, 6)
    out = set()
    for i, row in enumerate(sims):
        order = [j for j in np.lexsort((np.arange(len(b)), -row)).tolist() if not (same and i == j)][:k]
        out |= {(first + i, j, round(float(row[j]), 5), rank) for rank, j in enumerate(order, 1)}
    return out


def _found(df):
    return {(r["query"], r["neighbour"], round(r["sim"], 5), r["rank"]) for r in df.collect()}


def _clusters(rng, n, dim=12, groups=25, spread=0.02):
    centres = rng.normal(size=(groups, dim))
    v = centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dim))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _shapes():
    rng = np.random.default_rng(4)
    scale = lambda n: 10 ** rng.uniform(-2, 2, size=(n, 1))
    return {"random": (rng.normal(size=(60, 6)), rng.normal(size=(700, 6))),
            "clustered": (_clusters(np.random.default_rng(1), 80), _clusters(np.random.default_rng(1), 1500)),
            "unnormalised": (rng.normal(size=(50, 5)) * scale(50), rng.normal(size=(600, 5)) * scale(600)),
            "repeated": (np.ones((5, 3)), np.repeat(rng.normal(size=(4, 3)), 200, axis=0)),
            "zero": (np.zeros((3, 4)), np.r_[np.zeros((50, 4)), rng.normal(size=(50, 4))])}


@pytest.mark.parametrize("shape", list(_shapes()))
def test_cells_give_the_neighbours_of_brute_force(spark, shape):
    q, b = _shapes()[shape]
    report = {}
    got = SIM.nearest(_vectors(spark, q), _vectors(spark, b), k=4, block_rows=40, cell_rows=30, report=report)
    assert _found(got) == _brute(q, b, 4)
    assert report["pairs_all"] == len(q) * len(b) and 0 < report["pairs_scored"] <= report["pairs_all"]
    if shape == "clustered":
        assert report["pairs_scored"] < 0.25 * report["pairs_all"], report
        assert report["block_pairs_scored"] < report["block_pairs_all"]


def test_cells_with_few_rows_and_without_self(spark):
    v = _clusters(np.random.default_rng(3), 300, dim=5, groups=7)
    df = _vectors(spark, v)
    assert _found(SIM.nearest(df, df, k=3, block_rows=25, cell_rows=2, exclude_self=True)) == _brute(v, v, 3, same=True)
    # more neighbours asked than there are
    assert _found(SIM.nearest(df.limit(4), df.limit(30), k=50, block_rows=10, cell_rows=3)) == {
        x for x in _brute(v[:4], v[:30], 50)}


def test_number_of_cells_is_bounded(spark, monkeypatch):
    v = np.random.default_rng(5).normal(size=(200, 4))
    monkeypatch.setattr(SIM, "CENTRE_BYTES", 5 * 8 * 4)
    rows, cells = SIM.cell_index(_vectors(spark, v), 200, 4, cell_rows=1)
    assert len(cells.size) == 5 and cells.size.sum() == 200
    rows = rows.collect()
    for r in rows:
        away = np.linalg.norm(np.array(r["v"]) - cells.centres[r["cell"]])
        assert away <= cells.radius[r["cell"]] + 1e-9 and away <= np.linalg.norm(np.array(r["v"]) - cells.centres, axis=1).min() + 1e-9
    q = np.random.default_rng(6).normal(size=(20, 4))
    dots = q @ np.array([r["v"] for r in rows]).T
    assert (dots <= cells.bounds(q)[:, [r["cell"] for r in rows]] + 1e-9).all()


def test_vectors_of_different_lengths_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "key bigint, features array<float>")
    with pytest.raises(ValueError):
        SIM.nearest(df, df)
    none = df.limit(0)
    assert SIM.nearest(none, df).collect() == [] and SIM.nearest(df, none).collect() == []


def test_exclude_self(spark):
    rows = [(i, [float(i), 1.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "key bigint, features array<float>")
    got = SIM.nearest(df, df, k=2, exclude_self=True, block_rows=3).collect()
    assert all(r["query"] != r["neighbour"] for r in got) and len(got) == 20


def test_retrieve_picks_consensus(spark):
    nb = spark.createDataFrame([(100, 1, 0.9, 1), (100, 2, 0.8, 2)],
                               "query bigint, neighbour bigint, sim double, rank int")
    caps = spark.createDataFrame(
        [(1, 0, "a dog runs"), (1, 1, "zebra"), (2, 0, "a dog runs fast"), (2, 1, "a cat")],
        "key bigint, caption_no bigint, caption string")
    r = SIM.retrieve_caption(nb, caps).first()
    assert (r["key"], r["caption_no"]) == (1, 0)


def _peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_pair_of_blocks_is_scored_in_bounded_memory():
    """All similarities of the two blocks would take 200 MB, and as much again for each step on them."""
    v = np.random.default_rng(0).normal(size=(5000, 8)).astype(np.float32)
    q, b = pd.DataFrame({"q": range(5000), "v": list(v)}), pd.DataFrame({"b": range(5000), "v": list(v)})
    out = []
    assert _peak_mb(lambda: out.append(SIM._block_topk(3, 6)(q, b))) < 100
    best = out[0].sort_values(["sim", "neighbour"], ascending=[False, True]).groupby("query").first()
    sims = np.round(v.astype(np.float64) @ v.astype(np.float64).T, 6)
    assert np.array_equal(best["neighbour"].to_numpy(), sims.argmax(1)) and len(out[0]) == 15000


def test_visits_leave_the_task_in_bounded_batches():
    """A query without near cells visits all of them; its vector goes along to each."""
    dim, cells, n = 64, 4000, 300
    v = pa.array(np.random.default_rng(0).normal(size=(n, dim)).astype(np.float32).tolist(), pa.list_(pa.float32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), v, pa.array([None] * n, pa.float64())], ["q", "v", "least"])
    sizes, seen = [], 0
    for out in SIM._visited(iter([batch]), lambda x, least: np.ones((len(x), cells), bool), dim, cells):
        sizes.append(out.column("v").nbytes)
        seen += int(out.column("q").to_numpy().sum()) + out.num_rows
    assert max(sizes) <= SIM.VISIT_BYTES and seen == cells * sum(range(n)) + cells * n


def test_equal_vectors_are_one_centre(spark):
    """A base of few vectors that come often has as many cells as one without copies."""
    v = np.random.default_rng(8).normal(size=(40, 4))
    rows, cells = SIM.cell_index(_vectors(spark, np.repeat(v, 25, axis=0)), 1000, 4, cell_rows=25)
    assert len(cells.size) == 40 and set(cells.size.tolist()) == {25} and rows.count() == 1000


def test_small_blocks_do_not_make_a_group_for_each_cell(spark, monkeypatch):
    """Cells are scored a chunk at a time, also where chunks and queries are split into parts."""
    q, b = _shapes()["clustered"]
    report = {}
    got = SIM.nearest(_vectors(spark, q), _vectors(spark, b), k=4, block_rows=8, cell_rows=4, report=report)
    assert _found(got) == _brute(q, b, 4) and report["block_pairs_scored"] == 2  # a group in each round
    monkeypatch.setattr(SIM, "BLOCK_BYTES", 20 * 8 * b.shape[1])
    for shape in ("clustered", "random", "repeated"):
        q, b = _shapes()[shape]
        report = {}
        got = SIM.nearest(_vectors(spark, q), _vectors(spark, b), k=4, block_rows=8, cell_rows=4, report=report)
        assert _found(got) == _brute(q, b, 4) and report["block_pairs_scored"] > 2
