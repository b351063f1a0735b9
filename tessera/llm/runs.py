"""Runs (maximal repetitions) of words by a grammar of the text.

A run is a stretch of consecutive words with smallest period q, at least ``min_length`` words and
``min_periods`` periods long, that no neighbouring word extends with that period.

For the words of one document:

1. Words that lie in no repeated stretch of ``min_length // 2`` words are in no run: of two periods
   or more, one stretch of that length always stands one period further on. They part the text into
   segments, and a sequence without repeats is left out whole.
2. Re-Pair: the most frequent pair of neighbouring symbols becomes a nonterminal, until no pair
   occurs twice. The symbols that are left are joined two by two, so that they have boundaries too.
3. A run lies across the boundary of the lowest node of the derivation that holds all of it. For
   each nonterminal, whose text is the same wherever it stands, the runs across the boundary of its
   two halves are computed once, at its first place: a period q needs a word beside the boundary that
   returns q words on, and the run is as long as both sides agree. Common stretches are found by names
   for all stretches of 2^k words, so comparisons are exact.
4. The runs found are translated to all places of the nonterminal, and intervals of one period
   that overlap by a period or more are merged, which leaves the maximal ones. Of equal intervals
   the smallest period counts.

A document is worked on by one task, in a time that grows with n log n. Words are runs of anything
but ASCII white space, compared as they are. A null or empty text has no words and no runs. Each row
gives one row, rows that repeat an id too. Other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import id_type, narrow, slices

MIN_LENGTH = 12
MIN_PERIODS = 2
#: Comparisons that are made at a time.
STEP = 1 << 20
#: Words whose number a task keeps; the dictionary is begun again beyond.
KEEP_WORDS = 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_GONE = -1


def repeated(ids: np.ndarray, first: np.ndarray, g: int) -> np.ndarray:
    """True for words in a stretch of ``g`` words that occurs twice in its document.

    ``first`` has the start of each document and the end. Stretches are compared by a 64-bit
    hash; an error only keeps words that could go.
    """
    n = len(ids) - g + 1
    live = np.zeros(len(ids) + 1, np.int64)  # starts less ends
    if n > 0:
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        h = doc[:n].astype(np.uint64) * _MIX
        for i in range(g):
            h = (h ^ ids[i:i + n].astype(np.uint64)) * _MIX
            h ^= h >> np.uint64(29)
        at = np.flatnonzero(doc[:n] == doc[g - 1:])
        order = np.argsort(h[at], kind="stable")
        equal = h[at][order]
        same = equal[1:] == equal[:-1]
        at = at[order[np.r_[same, False] | np.r_[False, same]]] if len(at) else at
        np.add.at(live, at, 1)
        np.add.at(live, at + g, -1)
    return np.cumsum(live)[:-1] > 0


def repair(symbols: list[int], fresh: int) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """(symbols left, their places, rules): nonterminal ``fresh + i`` stands for the pair ``rules[i]``.

    Symbols below 0 are in no pair. Of equally frequent pairs the one that was seen first goes
    first, so that nonterminals of a repeated stretch grow evenly.
    """
    n = len(symbols)
    sym, after, before = [*symbols, _GONE], list(range(1, n + 1)), list(range(-1, n - 1))
    where: dict[tuple[int, int], list[int]] = {}
    for i in range(n - 1):
        if sym[i] >= 0 and sym[i + 1] >= 0:
            where.setdefault((sym[i], sym[i + 1]), []).append(i)
    heap = [(-len(at), k, pair) for k, (pair, at) in enumerate(where.items()) if len(at) > 1]
    heapq.heapify(heap)
    tick, rules = len(heap) + len(where), []
    while heap:
        claimed, _, pair = heapq.heappop(heap)
        a, b = pair
        alive = [i for i in where.pop(pair) if sym[i] == a and sym[after[i]] == b]
        use = alive
        if a == b:  # occurrences that overlap count once
            use, end = [], -1
            for i in alive:
                if i >= end:
                    use.append(i)
                    end = after[after[i]]
        if len(use) < 2:
            continue
        if len(use) < -claimed:  # some are gone since it was counted
            where[pair] = alive
            heapq.heappush(heap, (-len(use), tick, pair))
            tick += 1
            continue
        new, found = fresh + len(rules), {}
        rules.append(pair)
        for i in use:
            j = after[i]
            right, left = after[j], before[i]
            sym[i], sym[j], after[i] = new, _GONE, right
            if right < n:
                before[right] = i
                if sym[right] >= 0:
                    found.setdefault((new, sym[right]), []).append(i)
            if left >= 0 and sym[left] >= 0:
                found.setdefault((sym[left], new), []).append(left)
        for p, at in found.items():
            where[p] = at
            if len(at) > 1:
                heapq.heappush(heap, (-len(at), tick, p))
                tick += 1
    places, i = [], 0
    while i < n:
        places.append(i)
        i = after[i]
    return [sym[i] for i in places], places, rules


def boundaries(symbols: list[int], at: int, fresh: int, least: int) -> list[tuple[int, int, int, list[int]]]:
    """(start, boundary, end, all starts) of each node of the derivation with at least ``least`` words; ``at``: place of the first symbol."""
    left, places, rules = repair(symbols, fresh)
    lengths = [0] * len(rules)
    size = lambda s: lengths[s - fresh] if s >= fresh else 1
    for k, (a, b) in enumerate(rules):
        lengths[k] = size(a) + size(b)
    starts: list[list[int]] = [[] for _ in rules]
    for s, p in zip(left, places):
        if s >= fresh:
            starts[s - fresh].append(at + p)
    out = []
    for k in reversed(range(len(rules))):  # a rule uses older symbols only
        a, b = rules[k]
        if a >= fresh:
            starts[a - fresh] += starts[k]
        if b >= fresh:
            starts[b - fresh] += [p + size(a) for p in starts[k]]
        if lengths[k] >= least:
            p = starts[k][0]
            out.append((p, p + size(a), p + lengths[k], starts[k]))
    # the symbols that are left, between separators, as a balanced tree
    ends = [*places[1:], len(symbols)]
    stack, low = [], 0
    for i, s in enumerate([*left, _GONE]):
        if s < 0:
            stack.append((low, i))
            low = i + 1
    while stack:
        low, high = stack.pop()
        if high - low < 2 or ends[high - 1] - places[low] < least:
            continue
        mid = (low + high) // 2
        out.append((at + places[low], at + places[mid], at + ends[high - 1], [at + places[low]]))
        stack += [(low, mid), (mid, high)]
    return out


class Stretches:
    """Names of all stretches of 2^k symbols; equal names, equal stretches."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.n = len(symbols)
        self.names = [np.unique(symbols, return_inverse=True)[1]]
        k = 1
        while 2 * k <= longest and 2 * k <= self.n:
            x = self.names[-1]
            self.names.append(np.unique(x[:len(x) - k] * np.int64(self.n) + x[k:], return_inverse=True)[1])
            k *= 2

    def agree(self, i: np.ndarray, j: np.ndarray, room: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols agree from ``i`` and ``j`` on, or before them, up to ``room``."""
        i, j, room = i.copy(), j.copy(), room.copy()
        total = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.names))):
            step, names = 1 << k, self.names[k]
            while True:  # the longest stretches may fit more than once
                a, b = (i, j) if forward else (i - step, j - step)
                top = len(names) - 1
                same = (room >= step) & (names[np.clip(a, 0, top)] == names[np.clip(b, 0, top)])
                moved = np.where(same, step, 0)
                total += moved
                room -= moved
                i, j = (i + moved, j + moved) if forward else (i - moved, j - moved)
                if k < len(self.names) - 1 or not same.any():
                    break
        return total


def _crossing(symbols: np.ndarray, nodes, names: Stretches, min_length: int, min_periods: int):
    """(start, end, period) arrays of the runs across the nodes' boundaries, at all places of the nodes."""
    def found(node, q, right):
        start, at, end = bounds[node].T
        i, j = (at, at + q) if right else (at - q, at)
        back, on = names.agree(i, j, i - start, False), names.agree(i, j, end - j, True)
        s, e = i - back, j + on
        ok = (s < at) & (e > at) & (e - s >= np.maximum(min_length, min_periods * q))
        return np.stack([node[ok], s[ok], e[ok], q[ok]])

    bounds = np.array([x[:3] for x in nodes], np.int64).reshape(-1, 3)
    parts, waiting, size = [], ([], []), 0
    for k, (start, at, end, _) in enumerate(nodes):
        # the word before the boundary returns q words on, or the word behind it was there q words ago
        both = (np.flatnonzero(symbols[at:end] == symbols[at - 1]) + 1, at - start - np.flatnonzero(symbols[start:at] == symbols[at]))
        for side, q in zip(waiting, both):
            side.append((k, q))
            size += len(q)
        if size > STEP or k + 1 == len(nodes):
            for side, right in zip(waiting, (True, False)):
                node = np.repeat([x[0] for x in side], [len(x[1]) for x in side])
                if len(node):
                    parts.append(found(node, np.concatenate([x[1] for x in side]), right))
            waiting, size = ([], []), 0
    if not parts:
        return np.empty((3, 0), np.int64)
    node, s, e, q = np.concatenate(parts, axis=1)
    order = np.lexsort((q, e, s, node))
    node, s, e, q = node[order], s[order], e[order], q[order]
    fresh = np.r_[True, (np.diff(node) != 0) | (np.diff(s) != 0) | (np.diff(e) != 0)] if len(node) else np.zeros(0, bool)
    node, s, e, q = node[fresh], s[fresh], e[fresh], q[fresh]
    places = [np.array(nodes[k][3], np.int64) - nodes[k][0] for k in node.tolist()]
    times = [len(x) for x in places]
    move = np.concatenate(places) if places else np.empty(0, np.int64)
    return np.stack([np.repeat(s, times) + move, np.repeat(e, times) + move, np.repeat(q, times)])


def _merged(s: np.ndarray, e: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Maximal intervals of each period; of equal intervals the smallest period."""
    if not len(s):
        return np.empty((3, 0), np.int64)
    order = np.lexsort((s, q))
    s, e, q = s[order], e[order], q[order]
    period = np.cumsum(np.r_[0, np.diff(q) != 0])
    shift = period * (e.max() + 1)  # periods follow each other, so that one running maximum serves all
    reach = np.maximum.accumulate(e + shift)
    fresh = np.r_[True, (np.diff(q) != 0) | (s[1:] + shift[1:] > reach[:-1] - q[1:])]
    at = np.flatnonzero(fresh)
    s, q, e = s[at], q[at], np.maximum.reduceat(e, at)
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    first = np.r_[True, (np.diff(s) != 0) | (np.diff(e) != 0)]
    return np.stack([s[first], e[first], q[first]])


def slice_runs(ids: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """(start, end, period) rows of the runs of several documents; ``first`` has their starts and the end."""
    live = repeated(ids, first, max(min_length // 2, 1))
    at = np.flatnonzero(live)
    if not len(at):
        return np.empty((3, 0), np.int64)
    doc = np.searchsorted(first, at, "right") - 1
    gap = np.r_[False, (np.diff(at) > 1) | (np.diff(doc) > 0)]
    to = np.arange(len(at)) + np.cumsum(gap)  # one place between segments for a separator
    symbols = np.full(to[-1] + 1, _GONE, np.int64)
    symbols[to] = np.unique(ids[at], return_inverse=True)[1]
    origin = np.zeros(len(symbols), np.int64)
    origin[to] = at
    between = np.flatnonzero(symbols < 0)
    symbols[between] = -2 - np.arange(len(between))  # each its own
    fresh, nodes = int(symbols.max()) + 1, []
    ends = np.flatnonzero(np.r_[np.diff(doc) > 0, True])
    low = 0
    for last in ends.tolist():
        start, end = int(to[low]), int(to[last]) + 1
        nodes += boundaries(symbols[start:end].tolist(), start, fresh, min_length)
        low = last + 1
    if not nodes:
        return np.empty((3, 0), np.int64)
    names = Stretches(symbols, max(x[2] - x[0] for x in nodes))
    s, e, q = _merged(*_crossing(symbols, nodes, names, min_length, min_periods))
    s, e = origin[s], origin[e - 1] + 1
    order = np.lexsort((q, s))
    return np.stack([s[order], e[order], q[order]])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): one row per input row.

    ``runs`` are the (start, length, period) by start and period; ``collapsed`` is the text without
    the words that a run holds after its first period, joined by one space.
    """
    if min_length < 2 or min_periods < 2:
        raise ValueError("min_length and min_periods are at least 2")
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        known = _Numbers()
        for batch in slices(batches):
            split = [(x or b"").split() for x in batch.column("text").cast(pa.binary()).to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(x) for x in split], dtype=np.int64)])
            if len(known) > KEEP_WORDS:
                known = _Numbers()
            ids = np.fromiter((known[w] for x in split for w in x), np.int64, first[-1])
            s, e, q = slice_runs(ids, first, min_length, min_periods)
            mark = np.zeros(len(ids) + 1, np.int64)
            np.add.at(mark, s + q, 1)
            np.add.at(mark, e, -1)
            kept = np.cumsum(mark)[:-1] == 0
            doc = np.searchsorted(first, s, "right") - 1
            offsets = np.searchsorted(doc, np.arange(len(split) + 1)).astype(np.int32)
            rows = pa.StructArray.from_arrays([pa.array(s - first[doc]), pa.array(e - s), pa.array(q)], fields=list(run_type))
            touched = set(doc.tolist())
            collapsed = [b" ".join([w for w, k in zip(x, kept[first[i]:first[i + 1]].tolist()) if k]) if i in touched else b" ".join(x)
                         for i, x in enumerate(split)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(offsets), rows),
                                              pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return narrow(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {id_type(docs, id_col)}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
