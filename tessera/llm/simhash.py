"""SimHash near duplicates through a Gray-order hierarchical index.

A fingerprint bit is set when it is set in over half of the hashes of a text's word shingles.
Fingerprints at ``max_bits`` or fewer differing bits are linked, and links are followed to
connected components.

Distinct fingerprints are dealt into groups that agree on one quarter of the bits; two
fingerprints that differ in three bits agree on at least one of four quarters (for another
limit, of one part more than the limit), so no link is lost. A group with more than ``GROUP`` members is dealt again by quarters of its other bits,
and again, until it is small or has so few free bits that its size is bounded: nothing is
capped. Inside a group the fingerprints are sorted by Gray rank, which puts those that differ
in few leading bits side by side, and every ``FAN`` neighbours share a node that holds the bits
on which all agree. A bit that a node holds is left out below it. A search adds up the
differences from the root down and drops a node, with all below it, once they exceed the limit.
Each group returns a forest, not all pairs, so a clique of near copies costs as many rows as it
has members.

Words are runs of anything but ASCII white space, A-Z in lower case. Null texts count as empty;
texts without words have fingerprint zero, linked like any other. Null ids take part in the
links and are ignored where the smallest id is taken. Other columns are not read by
``near_groups`` and pass unchanged through ``drop_near_duplicates``; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, id_type, narrow, slices, texts
from tessera.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Members of a group that are searched in one go; larger groups are dealt again.
GROUP = 2048
#: Children of a node of the index.
FAN = 16
#: A group whose fingerprints agree on all but so many bits is bounded by 2 ** FREE_BITS members.
FREE_BITS = 16
#: Index entries compared at a time.
FRONTIER = 1 << 20
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    words = text.encode().lower().split()
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, n)
    lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if n < 256:
        ones = np.unpackbits(lanes, axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fp", shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the fingerprint as a signed long."""
    keep = docs.columns if keep is None else keep

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = np.fromiter((fingerprint(t, shingle) for t in texts(b, text_col)), np.uint64, b.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(found)], names=[*keep, name])

    schema = ", ".join(f"`{c}` {id_type(docs, c)}" for c in keep) + f", `{name}` long"
    return docs.mapInArrow(add, schema)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in Gray order."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def parts_of(mask: int, parts: int) -> list[int]:
    """Masks that fix, beside the bits of ``mask``, one part of the bits it leaves free."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class GrayIndex:
    """Index over groups of fingerprints; ``links()`` gives the pairs of a group within the limit."""

    def __init__(self, values: np.ndarray, group: np.ndarray, max_bits: int = MAX_BITS):
        order = np.lexsort((gray_rank(values), group))
        self.values, self.max_bits = values[order], max_bits
        group = group[order]
        # from leaves to roots: (group, all-and, all-or, first child, end of children, last leaf)
        leaf = np.arange(len(values))
        levels = [(group, self.values, self.values, leaf, leaf + 1, leaf)]
        while True:
            g, low, high, _, _, last = levels[-1]
            first_of_group = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            if len(first_of_group) == len(g) and len(levels) > 1:
                break
            place = np.arange(len(g)) - np.repeat(first_of_group, np.diff(np.r_[first_of_group, len(g)]))
            start = np.flatnonzero(place % FAN == 0)
            end = np.r_[start[1:], len(g)]
            levels.append((g[start], np.bitwise_and.reduceat(low, start), np.bitwise_or.reduceat(high, start), start, end, last[end - 1]))
        # from roots to leaves: the bits that a node adds to those of its parent, and their pattern
        self.levels, parent_mask = [], None
        for g, low, high, start, end, last in reversed(levels):
            mask = ~(low ^ high)
            own = mask if parent_mask is None else mask & ~np.repeat(parent_mask, parent_fan)
            parent_mask, parent_fan = mask, end - start
            self.levels.append((low & own, own, start, end, last))
        root_of_group = levels[-1][0]
        self.root = np.searchsorted(root_of_group, group) if len(group) else group

    def links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i < j, of places in ``values``; a bounded number of entries at a time."""
        query = np.arange(len(self.values))
        stack = [(0, query[i:i + FRONTIER // FAN], self.root[i:i + FRONTIER // FAN], None) for i in range(0, len(query), FRONTIER // FAN)]
        while stack:
            level, q, node, differences = stack.pop()
            if differences is None:
                differences = np.zeros(len(q), np.uint8)
            pattern, own, start, end, last = self.levels[level]
            differences = differences + np.bitwise_count((self.values[q] ^ pattern[node]) & own[node])
            near = (differences <= self.max_bits) & (last[node] > q)
            q, node, differences = q[near], node[near], differences[near]
            if level == len(self.levels) - 1:
                if len(q):
                    yield q, node
                continue
            below = end[node] - start[node]
            for part in np.array_split(np.arange(len(q)), max(1, -(-int(below.sum()) // FRONTIER))):
                n = below[part]
                if not len(part):
                    continue
                offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                stack.append((level + 1, np.repeat(q[part], n), np.repeat(start[node[part]], n) + offset, np.repeat(differences[part], n)))


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Hook the trees of the linked places together; ``label`` points at roots before and after."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, jumped := label[label]):
            label[:] = jumped


def _forest(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """From rows of groups, edges (a, b) that link each member to one root of what it reaches."""
    for batch in slices(batches, 1024):
        column = batch.column("members")
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        sizes = np.diff(column.offsets.to_numpy())
        index = GrayIndex(values, np.repeat(np.arange(len(sizes)), sizes), max_bits)
        label = np.arange(len(values))
        for a, b in index.links():
            _joined(label, a, b)
        linked = np.flatnonzero(label != np.arange(len(values)))
        found = index.values.view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(found[linked]), pa.array(found[label[linked]])], names=["a", "b"])


def groups(fingerprints: DataFrame, max_bits: int = MAX_BITS, size: int = GROUP) -> DataFrame:
    """(mask, key, members): groups of two or more distinct fingerprints that agree on a mask's bits."""
    spark = fingerprints.sparkSession
    masks, done = parts_of(0, max_bits + 1), []
    rows = fingerprints.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    while True:
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        if 64 - bin(masks[0]).count("1") <= FREE_BITS:
            done.append(rows)
            break
        large = cut(rows.groupBy("mask", "key").count().filter(F.col("count") > size).select("mask", "key"))
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, ["mask", "key"], "left_anti").select("fp", "mask", "key"))
        finer = sorted({(_signed(m), _signed(x)) for m in masks for x in parts_of(m, max_bits + 1)})
        masks = sorted({x for m in masks for x in parts_of(m, max_bits + 1)})
        deal = spark.createDataFrame(finer, "mask long, finer long")
        # dealt again by different ways, some would fall into the same group twice
        rows = cut(rows.join(large, ["mask", "key"], "left_semi").join(F.broadcast(deal), "mask")
                   .select("fp", F.col("finer").alias("mask")).distinct())
    together = done[0]
    for more in done[1:]:
        together = together.unionByName(more)
    return together.groupBy("mask", "key").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1)


def fingerprint_components(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(node, root) for the fingerprints that have a link; ``fp`` must be distinct."""
    members = groups(fingerprints, max_bits).select("members")
    return components(members.mapInArrow(partial(_forest, max_bits=max_bits), "a long, b long"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): one row per input row."""
    rows = cut(with_fingerprint(narrow(docs, id_col, text_col), "text", "fp", shingle, ["doc_id"]))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    linked = fingerprint_components(distinct.select("fp"), max_bits)
    rooted = cut(distinct.join(linked, distinct["fp"] == linked["node"], "left")
                 .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    smallest = cut(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")))
    classes = cut(rooted.join(smallest, "root").select("fp", "component_id"))
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def unsigned_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """The input rows that stay, with all their columns: the smallest id of each component.

    Rows that repeat an id and a fingerprint are one document, of which one row stays. A
    component of null ids only keeps one row of each of its fingerprints.
    """
    found = near_groups(docs, id_col, text_col, shingle, max_bits)
    stays = cut(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_nd_id"), F.col("fp").alias("_nd_fp")).distinct())
    tagged = with_fingerprint(docs, text_col, "_nd_key", shingle)
    same = tagged[id_col].eqNullSafe(stays["_nd_id"]) & (tagged["_nd_key"] == stays["_nd_fp"])
    repeated = cut(found.groupBy("doc_id", "fp").count().filter("count > 1").select(F.col("doc_id").alias("_nd_id"), F.col("fp").alias("_nd_fp")))
    kept = tagged.join(stays, same, "left_semi")
    if repeated.isEmpty():
        return kept.drop("_nd_key")
    again = kept[id_col].eqNullSafe(repeated["_nd_id"]) & (kept["_nd_key"] == repeated["_nd_fp"])
    once = kept.join(repeated, again, "left_anti")
    twice = kept.join(repeated, again, "left_semi").dropDuplicates([id_col, "_nd_key"])
    return once.unionByName(twice).drop("_nd_key")
