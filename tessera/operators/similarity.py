"""Exact k nearest neighbours by dot product, and nearest-neighbour caption retrieval.

``nearest`` never forms a cross join. A base that fits one block is multiplied with blocks of
queries. A larger one is dealt to cells (``cell_index``): the vectors nearest to one of a bounded
number of centres, with the cell's radius and longest vector. A query visits the cells with the
best centres first; its k-th similarity there is the least that matters, and by the bound of
Cauchy and Schwarz only cells that can reach it are visited in a second round. On vectors
without any structure the bound spares little and the work is that of all pairs, in the same
blocks.

Blocks of either side are bounded in bytes whatever the data size. Each pair of blocks is one group of
a cogrouped ``applyInPandas``, multiplied by NumPy a few queries at a time, so that the similarities
in memory are bounded too, and only the k best per query and block leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.session import ensure_checkpoint_dir

SIM_DECIMALS = 6
#: Vectors of one side that a task multiplies at once.
BLOCK_BYTES = 16 << 20
#: Base rows that a cell should have, and bounds on the number of cells.
CELL_ROWS = 1024
MAX_CELLS = 4096
CENTRE_BYTES = 16 << 20
#: Numbers of a matrix of queries against cells, or against the base rows of a block, that a task holds at once.
STEP_NUMBERS = 1 << 20
#: Queries that are multiplied at once with the cells that one of them visits.
QUERY_ROWS = 64
#: Vectors of an Arrow batch of visits: a query's vector goes along to each cell it visits.
VISIT_BYTES = 4 << 20


def _steps(vectors: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, matrix) of so few vectors that ``width`` numbers for each of them stay within ``STEP_NUMBERS``."""
    rows = max(1, STEP_NUMBERS // width)
    for i in range(0, len(vectors), rows):
        yield i, np.stack(vectors[i:i + rows]).astype(np.float64)


def _block_topk(k: int, decimals: int):
    def run(qpdf: pd.DataFrame, bpdf: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": qpdf["q"].iloc[:0], "neighbour": bpdf["b"].iloc[:0],
                              "sim": pd.Series([], dtype="float64")})
        if len(qpdf) == 0 or len(bpdf) == 0:
            return empty
        order = np.argsort(bpdf["b"].to_numpy(), kind="stable")
        bids = bpdf["b"].to_numpy()[order]
        bv = np.stack(bpdf["v"].to_numpy()[order]).astype(np.float64)
        kk = min(k, bv.shape[0])
        found = []
        # a matrix of all queries against the block would take a gigabyte for each 11,000 rows of either side
        for at, qv in _steps(qpdf["v"].to_numpy(), bv.shape[0]):
            sims = np.round(qv @ bv.T, decimals)
            scaled = np.rint(sims * 10 ** decimals)
            if np.abs(scaled).max(initial=0.0) * bv.shape[0] < 2.0 ** 61:
                # rank by (similarity desc, neighbour id asc): one integer composite per cell
                composite = -scaled.astype(np.int64) * bv.shape[0] + np.arange(bv.shape[0])
                cols = np.argpartition(composite, kk - 1, axis=1)[:, :kk].ravel()
            else:  # huge magnitudes: exact two-key sort per query row
                cols = np.concatenate([np.lexsort((np.arange(bv.shape[0]), -row))[:kk] for row in scaled])
            rows = np.repeat(np.arange(qv.shape[0]), kk)
            found.append((at + rows, cols, sims[rows, cols]))
        rows, cols, sims = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.DataFrame({"query": qpdf["q"].to_numpy()[rows], "neighbour": bids[cols], "sim": sims})
    return run


def _top(cand: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.col("sim").desc(), F.col("neighbour").asc())
    return cand.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= k)


def _every_block(q: DataFrame, b: DataFrame, blocks: tuple[int, int], k: int, schema: str) -> DataFrame:
    """Candidates from every pair of blocks. Blocks by a hash of (id, vector), so that duplicate ids still spread."""
    bq, bb = blocks
    qs = (q.withColumn("qb", F.pmod(F.xxhash64("q", "v"), F.lit(bq)))
          .withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(bb - 1)))))
    bs = (b.withColumn("bb", F.pmod(F.xxhash64("b", "v"), F.lit(bb)))
          .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(bq - 1)))))
    return qs.groupBy("qb", "bb").cogroup(bs.groupBy("qb", "bb")).applyInPandas(_block_topk(k, SIM_DECIMALS), schema)


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _in_steps(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Slices of so few rows that a row of ``width`` numbers for each of them stays small."""
    rows = max(1, STEP_NUMBERS // width)
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


@dataclass(frozen=True)
class Cells:
    """Cells of base vectors, each of the vectors nearest to its centre.

    ``size`` counts a cell's rows, ``radius`` is the largest distance from the centre and ``norm`` the
    longest vector. A vector of the cell has a dot product with q of at most
    ``min(q . centre + |q| radius, |q| norm)``.
    """

    centres: np.ndarray
    size: np.ndarray
    radius: np.ndarray
    norm: np.ndarray

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """Upper bounds of the dot products: a row per query, a column per cell."""
        length = np.linalg.norm(q, axis=1)[:, None]
        return np.where(self.size, np.minimum(q @ self.centres.T + length * self.radius, length * self.norm), -np.inf)

    def home(self, q: np.ndarray, enough: int) -> np.ndarray:
        """True for the cells with the best centres that hold ``enough`` rows together."""
        order = np.argsort(np.where(self.size, -(q @ self.centres.T), np.inf), axis=1, kind="stable")
        before = np.cumsum(self.size[order], axis=1) - self.size[order]
        out = np.zeros(order.shape, bool)
        np.put_along_axis(out, order, (before < enough) & (self.size[order] > 0), axis=1)
        return out


def cell_index(base: DataFrame, n_rows: int, dim: int, key: str = "key", vec: str = "features",
               cell_rows: int = CELL_ROWS) -> tuple[DataFrame, Cells]:
    """Deal ``n_rows`` vectors to cells of about ``cell_rows``: rows (b, v, cell, uid), written once, and the cells.

    The centres are base vectors with the smallest hash, at most ``MAX_CELLS`` of them and at most
    ``CENTRE_BYTES``: they, and two numbers for each cell, are all that the driver and the tasks hold.
    """
    n_cells = max(1, min(math.ceil(n_rows / cell_rows), MAX_CELLS, CENTRE_BYTES // (8 * dim)))
    b = base.select(F.col(key).alias("b"), F.col(vec).alias("v")).filter(F.col("v").isNotNull())
    # equal vectors are one centre, else a few vectors that come often leave few cells
    hashed = b.select("v", F.xxhash64("v").alias("h"))
    least = hashed.select("h").distinct().orderBy("h").limit(n_cells)
    picked = hashed.join(F.broadcast(least), "h").groupBy("h").agg(F.first("v").alias("v")).orderBy("h").collect()
    centres = np.array([r["v"] for r in picked], np.float64).reshape(-1, dim)
    half = (centres ** 2).sum(1) / 2

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_steps(batches, max(len(centres), dim)):
            v = _matrix(batch, dim)
            cell = np.argmax(v @ centres.T - half, axis=1)
            away, length = np.linalg.norm(v - centres[cell], axis=1), np.linalg.norm(v, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away), pa.array(length)],
                                             ["b", "v", "cell", "away", "length"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in b.schema)
    rows = (b.mapInArrow(assign, f"{fields}, cell int, away double, length double")
            .withColumn("uid", F.monotonically_increasing_id()).checkpoint(eager=True))
    size, radius, norm = (np.zeros(len(centres)) for _ in range(3))
    for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("away"), F.max("length").alias("length")).collect():
        size[r["cell"]], radius[r["cell"]], norm[r["cell"]] = r["n"], r["away"], r["length"]
    return rows.select("b", "v", "cell", "uid"), Cells(centres, size.astype(np.int64), radius, norm)


def _visited(batches: Iterator[pa.RecordBatch], choose: Callable[[np.ndarray, np.ndarray], np.ndarray], dim: int,
             width: int, chunk_of: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Batches (q, v, chunk, cells) of ``VISIT_BYTES`` of vectors at most, however many cells a query visits."""
    most = max(1, VISIT_BYTES // (8 * dim))
    chunk_of = np.arange(width) if chunk_of is None else chunk_of
    for batch in _in_steps(batches, max(width, dim)):
        least = batch.column("least").to_numpy(zero_copy_only=False).astype(np.float64)
        row, cell = np.nonzero(choose(_matrix(batch, dim), least))
        chunk = chunk_of[cell]
        begin = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (chunk[1:] != chunk[:-1])]) if len(row) else row
        edges = np.r_[begin, len(row)]
        for i in range(0, len(begin), most):
            at, ends = begin[i:i + most], edges[i:i + most + 1]
            cells = pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), pa.array(cell[ends[0]:ends[-1]].astype(np.int32)))
            rows = pa.array(row[at])
            yield pa.RecordBatch.from_arrays([batch.column("q").take(rows), batch.column("v").take(rows), pa.array(chunk[at].astype(np.int32)), cells],
                                             ["q", "v", "chunk", "cells"])


def _visits(q: DataFrame, choose: Callable[[np.ndarray, np.ndarray], np.ndarray], dim: int, width: int, chunk_of: np.ndarray) -> DataFrame:
    """(q, v, chunk, cells): each query with the cells that ``choose(vectors, least similarities)`` marks, a row for each chunk of cells."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in q.schema if f.name != "least")
    return q.mapInArrow(lambda batches: _visited(batches, choose, dim, width, chunk_of), f"{fields}, chunk int, cells array<int>")


def _chunks(size: np.ndarray, rows: int) -> np.ndarray:
    """The chunk of each cell: cells in their order, as many as have ``rows`` rows together, or one."""
    out, chunk, held = np.zeros(len(size), np.int64), 0, 0
    for c, n in enumerate(size.tolist()):
        if held and held + n > rows:
            chunk, held = chunk + 1, 0
        out[c], held = chunk, held + n
    return out


def _chunk_topk(k: int, decimals: int):
    """As ``_block_topk``, of the cells that each query visits. Queries with the same first cell are multiplied with all cells that one of them visits."""
    def run(qpdf: pd.DataFrame, bpdf: pd.DataFrame) -> pd.DataFrame:
        nq, nb = len(qpdf), len(bpdf)
        empty = pd.DataFrame({"query": qpdf["q"].iloc[:0], "neighbour": bpdf["b"].iloc[:0], "sim": pd.Series([], dtype="float64")})
        if not nq or not nb:
            return empty
        rank = np.empty(nb, np.int64)
        rank[np.argsort(bpdf["b"].to_numpy(), kind="stable")] = np.arange(nb)
        by = np.lexsort((rank, bpdf["cell"].to_numpy()))
        ids, rank, bv = bpdf["b"].to_numpy()[by], rank[by], np.stack(bpdf["v"].to_numpy()[by]).astype(np.float64)
        cells, cell = np.unique(bpdf["cell"].to_numpy()[by], return_inverse=True)
        lists = qpdf["cells"].to_numpy()
        row, asked = np.repeat(np.arange(nq), [len(x) for x in lists]), np.concatenate(lists)
        at = np.minimum(np.searchsorted(cells, asked), len(cells) - 1)
        visits = np.zeros((nq, len(cells)), bool)
        visits[row[cells[at] == asked], at[cells[at] == asked]] = True  # a part of a cell may have no rows
        order, step, found = np.argsort(visits.argmax(axis=1), kind="stable"), max(1, min(QUERY_ROWS, STEP_NUMBERS // nb)), []
        for i in range(0, nq, step):
            rows = order[i:i + step]
            cols = np.flatnonzero(visits[rows].any(axis=0)[cell])
            if not len(cols):
                continue
            sims = np.round(np.stack(qpdf["v"].to_numpy()[rows]).astype(np.float64) @ (bv if len(cols) == nb else bv[cols]).T, decimals)
            open_ = visits[rows][:, cell[cols]]
            scaled, kk = np.rint(sims * 10 ** decimals), min(k, len(cols))
            if np.abs(scaled).max(initial=0.0) * nb < 2.0 ** 61:
                composite = np.where(open_, -scaled.astype(np.int64) * nb + rank[cols], np.iinfo(np.int64).max)
                best = np.argpartition(composite, kk - 1, axis=1)[:, :kk]
            else:  # huge magnitudes: exact sort per query row
                best = np.stack([np.lexsort((rank[cols], -x, ~o))[:kk] for x, o in zip(scaled, open_, strict=True)])
            r, c = np.repeat(np.arange(len(rows)), kk), best.ravel()
            r, c = r[open_[r, c]], c[open_[r, c]]
            found.append((rows[r], cols[c], sims[r, c]))
        if not found:
            return empty
        rows, cols, sims = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.DataFrame({"query": qpdf["q"].to_numpy()[rows], "neighbour": ids[cols], "sim": sims})
    return run


def _visit(visits: DataFrame, rows: DataFrame, cells: Cells, chunk_of: np.ndarray, block_rows: int, k: int, schema: str, report: dict) -> DataFrame:
    """Candidates of each query from the cells it visits.

    The cells of a chunk, of ``block_rows`` rows or so, are one group. A chunk of more rows, which is one cell, or of more queries
    is split into parts; each pair of parts is one group.
    """
    spark = visits.sparkSession
    pairs = F.aggregate("cells", F.lit(0).cast("long"), lambda a, c: a + F.lit(cells.size.tolist())[c])
    asked = visits.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.sum(pairs).alias("pairs")).collect()  # a row per chunk
    held = np.bincount(chunk_of, cells.size)
    parts = [(r["chunk"], math.ceil(int(held[r["chunk"]]) / block_rows), math.ceil(r["n"] / block_rows)) for r in asked]
    report["pairs_scored"] += sum(r["pairs"] for r in asked)
    report["block_pairs_scored"] += sum(a * b for _, a, b in parts)
    table = F.broadcast(spark.createDataFrame(parts, "chunk int, parts int, q_parts int"))  # MAX_CELLS rows at most
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    chunk = F.broadcast(spark.createDataFrame(list(enumerate(chunk_of.tolist())), "cell int, chunk int"))
    qs = (visits.join(table, "chunk").withColumn("qp", F.pmod(F.xxhash64("q", "v"), F.col("q_parts")).cast("int"))
          .withColumn("bp", upto("parts")))
    bs = (rows.join(chunk, "cell").join(table, "chunk").withColumn("bp", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
          .withColumn("qp", upto("q_parts")))
    by = ["chunk", "bp", "qp"]
    return (qs.select(*by, "q", "v", "cells").groupBy(*by).cogroup(bs.select(*by, "b", "v", "cell").groupBy(*by))
            .applyInPandas(_chunk_topk(k, SIM_DECIMALS), schema))


def _by_cells(q: DataFrame, rows: DataFrame, cells: Cells, dim: int, block_rows: int, k: int, drop_self: bool, schema: str, report: dict) -> DataFrame:
    """Candidates in two rounds: the home cells give each query its k-th similarity, then come the cells whose bound reaches it."""
    width, enough = len(cells.size), k + drop_self
    block_rows = max(block_rows, BLOCK_BYTES // (8 * dim))  # a group for each small cell would take far longer than its product
    chunk_of = _chunks(cells.size, block_rows)

    def scored(visits: DataFrame) -> DataFrame:
        found = _visit(visits, rows, cells, chunk_of, block_rows, enough, schema, report)
        return found.filter(F.col("query") != F.col("neighbour")) if drop_self else found

    def further(v: np.ndarray, least: np.ndarray) -> np.ndarray:
        # similarities are rounded, and the bound is a sum of rounded products
        slack = 10.0 ** -SIM_DECIMALS + 1e-9 * np.linalg.norm(v, axis=1) * cells.norm.max()
        return (cells.bounds(v) >= (least - slack)[:, None]) & ~cells.home(v, enough)

    first = _visits(q.withColumn("least", F.lit(None).cast("double")), lambda v, least: cells.home(v, enough), dim, width, chunk_of)
    near = _top(scored(first), k).drop("rank").checkpoint(eager=True)
    least = near.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("sim")).otherwise(F.lit(float("-inf"))).alias("least"))
    asking = q.join(least, q["q"].eqNullSafe(least["query"]), "left").select("q", "v", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    return near.unionByName(scored(_visits(asking, further, dim, width, chunk_of)))


def nearest(query: DataFrame, base: DataFrame, k: int = 5, query_key: str = "key", base_key: str = "key",
            vec: str = "features", block_rows: int | None = None, exclude_self: bool = False,
            materialize: bool = True, cell_rows: int = CELL_ROWS, report: dict | None = None) -> DataFrame:
    """(query, neighbour, sim, rank): the k base rows with the largest dot product.

    Similarity is rounded to 6 decimals before ranking; ties go to the lowest neighbour id.
    ``block_rows`` is the most rows of a block of either side, by default as many as ``BLOCK_BYTES`` hold. A base of one such block
    is scored whole; a larger one through cells, of which a task takes as many as ``BLOCK_BYTES`` hold at a time.
    ``report`` receives the number of all pairs and of those scored, in vectors and in blocks.
    The result (k rows per query) is checkpointed reliably: downstream plans read it several
    times, and each read would otherwise rerun the block products.
    """
    ensure_checkpoint_dir(query.sparkSession)
    q = query.select(F.col(query_key).alias("q"), F.col(vec).alias("v")).filter(F.col("v").isNotNull())
    b = base.select(F.col(base_key).alias("b"), F.col(vec).alias("v")).filter(F.col("v").isNotNull())
    # both sizes in one job (a tagged union), to choose the block counts
    tagged = q.select(F.lit(0).alias("s"), F.size("v").alias("d")).unionByName(b.select(F.lit(1).alias("s"), F.size("v").alias("d")))
    sizes = {r["s"]: r for r in tagged.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("low"), F.max("d").alias("dim")).collect()}
    kq = query.schema[query_key].dataType.simpleString()
    kb = base.schema[base_key].dataType.simpleString()
    schema = f"query {kq}, neighbour {kb}, sim double"
    if len(sizes) < 2:
        return query.sparkSession.createDataFrame([], schema + ", rank int")
    nq, nb, dim = sizes[0]["n"], sizes[1]["n"], sizes[1]["dim"]
    if len({x for r in sizes.values() for x in (r["low"], r["dim"])}) > 1:
        raise ValueError("vectors differ in length")
    block_rows = block_rows or max(1, BLOCK_BYTES // (8 * max(dim, 1)))
    bq, bb = math.ceil(nq / block_rows), math.ceil(nb / block_rows)
    report = {} if report is None else report
    report.update(pairs_all=nq * nb, pairs_scored=0, block_pairs_all=bq * bb, block_pairs_scored=0)
    if bb == 1 or dim == 0:
        report.update(pairs_scored=nq * nb, block_pairs_scored=bq * bb)
        cand = _every_block(q, b, (bq, bb), k + exclude_self, schema)
        cand = cand.filter(F.col("query") != F.col("neighbour")) if exclude_self else cand
    else:
        rows, cells = cell_index(b, nb, dim, "b", "v", min(cell_rows, block_rows))
        report["block_pairs_all"] = sum(math.ceil(int(n) / block_rows) for n in cells.size) * bq
        cand = _by_cells(q, rows, cells, dim, block_rows, k, exclude_self, schema, report)
    out = _top(cand, k)
    return out.checkpoint(eager=True) if materialize else out


def retrieve_caption(neighbours: DataFrame, captions: DataFrame, key: str = "key",
                     order: str = "caption_no", text: str = "caption") -> DataFrame:
    """(query, key, caption_no, caption, score): the consensus caption among the neighbours'.

    Candidates are all captions of a query's neighbours. A candidate's score is its mean
    unigram precision against the other candidates (Devlin et al. 2015):
    sum over its distinct words w of (df(w) - 1) / (|words| * (N - 1)), where df(w) counts
    the query's candidates containing w and N the candidates. This needs only per-(query,
    word) counts - no candidate pairs are formed. Ties go to the lowest (key, caption_no).
    """
    near = neighbours.select("query", F.col("neighbour").alias(key))
    # scored by ids; the text of the chosen caption is fetched last
    cand = near.join(captions.select(key, order, F.array_distinct(T.tokenize(text)).alias("_w")), key)
    words = cand.select("query", key, order, F.explode("_w").alias("w"))
    dfq = words.groupBy("query", "w").agg(F.count(F.lit(1)).alias("df"))
    per = (words.join(dfq, ["query", "w"])
           .groupBy("query", key, order)
           .agg(F.sum(F.col("df") - 1).alias("s"), F.count(F.lit(1)).alias("u")))
    ids = cand.select("query", key, order)
    nq = ids.groupBy("query").agg(F.count(F.lit(1)).alias("N"))
    scored = (ids.join(nq, "query").join(per, ["query", key, order], "left")
              .withColumn("score", F.when((F.col("N") > 1) & (F.coalesce("u", F.lit(0)) > 0),
                                          F.col("s") / (F.col("u") * (F.col("N") - 1)))
                          .otherwise(F.lit(0.0))))
    best = F.min(F.struct((-F.col("score")).alias("ns"), F.col(key).alias(key), F.col(order).alias(order)))
    chosen = (scored.groupBy("query").agg(best.alias("_b"))
              .select("query", F.col(f"_b.{key}").alias(key), F.col(f"_b.{order}").alias(order), (-F.col("_b.ns")).alias("score")))
    return chosen.join(captions.select(key, order, text), [key, order]).select("query", key, order, text, "score")
