"""Merge-dropout encoding with a sentencepiece BPE vocabulary, seeded, and lossless decoding.

A chunk (a run of spaces and what follows up to the next space) is segmented by an agenda of
candidate merges, best score first, leftmost first among equals. Each candidate is skipped with
probability ``dropout``: keyed hashes of the seed, the document's id and the chunk's place say how
many candidates pass before the next one is skipped, so every occurrence of a chunk has draws of
its own, and the same seed gives the same ids on any cluster and after any retry. The agendas of a
batch's chunks are rows of one table, and each step takes the best candidate of every row. What a chunk
gives without skips is kept in a dictionary of bounded size. Without dropout the ids are those of the
plain encoder.

Characters outside the vocabulary, and a literal U+2581, are spelled in byte pieces, and a
leading space is put before the text, so decoding gives back every text exactly. Null texts
count as empty, and an empty text has no ids. Null ids are a key like others; rows that repeat
are encoded each. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_type, narrow, slices, texts

DROPOUT = 0.1
SEED = 20
#: Chunks kept in each of two generations.
KEEP = 400_000
#: Agendas that are one table, and characters of the texts whose chunks are dealt to tables together.
ROWS = 8192
CHARS = 1 << 20
#: Candidates that one draw can let pass; where all of them pass, another draw follows.
MOST_PASS = 4096
KEEP_CHARS = 48
_CHUNK = re.compile(r" +[^ ]*")


def _chunks(text: str) -> list[str]:
    if not text:
        return []
    return _CHUNK.findall(f" {text}") if "  " in f" {text}" else [f" {x}" for x in text.split(" ")]


class Vocabulary:
    """Pieces of a model with a space in place of U+2581, byte pieces, and their bytes by id.

    ``rank`` orders the pieces by score, best first, as small whole numbers.
    """

    def __init__(self, name: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.ids, self.byte_ids, self.spelled, scores = {}, [0] * 256, [], {}
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.spelled.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                piece = piece.replace("▁", " ")
                self.ids[piece], scores[piece] = i, model.get_score(i)
                self.spelled.append(piece.encode())
        place = {score: r for r, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {piece: place[score] for piece, score in scores.items()}


@cache
def vocabulary(name: str) -> Vocabulary:
    return Vocabulary(name)


def segment(chunk: str, vocab: Vocabulary, skips: Iterator[int]) -> tuple[list[int], int]:
    """Ids of a chunk and how many candidate merges were met; ``skips``: which of them are skipped, ascending.

    A candidate on the agenda is one number: its piece's rank, then where it starts and ends.
    """
    n = len(chunk)
    rank, bits, met, skip = vocab.rank.get, n.bit_length(), 0, next(skips, -1)
    mask = (1 << bits) - 1
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the symbol that starts at a place; end 0: merged away
    agenda = [(r << bits | i) << bits | i + 2 for i in range(n - 1) if (r := rank(chunk[i:i + 2])) is not None]
    heapq.heapify(agenda)
    pop, push = heapq.heappop, heapq.heappush
    while agenda:
        entry = pop(agenda)
        left, right = entry >> bits & mask, entry & mask
        middle = end[left]
        if not middle or middle >= right or end[middle] != right:
            continue  # one of its symbols has been merged since
        met += 1
        if met - 1 == skip:
            skip = next(skips, -1)
            continue
        end[left], end[middle] = right, 0
        if right < n:
            before[right] = left
            further = end[right]
            r = rank(chunk[left:further])
            if r is not None:
                push(agenda, (r << bits | left) << bits | further)
        start = before[left]
        if start >= 0:
            r = rank(chunk[start:right])
            if r is not None:
                push(agenda, (r << bits | start) << bits | right)
    out, at = [], 0
    while at < n:
        piece = chunk[at:end[at]]
        found = vocab.ids.get(piece)
        if found is None:
            out.extend(vocab.byte_ids[b] for b in piece.encode())
        else:
            out.append(found)
        at = end[at]
    return out, met


class _Pairs:
    """The pieces that pairs of neighbouring symbols make, for whole arrays.

    Symbols are the pieces and the characters that pieces consist of, by number; every other character
    has the last number and makes no piece. The pairs are in a table with linear probing.
    """

    NONE = np.int32(np.iinfo(np.int32).max)

    def __init__(self, vocab: Vocabulary):
        number = {piece: i for i, piece in enumerate(vocab.rank)}
        for piece in vocab.rank:
            for c in piece:
                number.setdefault(c, len(number))
        self.n = len(number) + 1
        self.ids = np.array([*(vocab.ids.get(x, -1) for x in number), -1], np.int64)
        self.rank = np.array([vocab.rank.get(x, self.NONE) for x in number], np.int32)
        self.byte_ids = np.array(vocab.byte_ids, np.int64)
        self.of_char = np.full(0x110000, len(number), np.int32)
        for x, i in number.items():
            if len(x) == 1:
                self.of_char[ord(x)] = i
        found = [(number[x[:k]] * self.n + number[x[k:]], i) for x, i in number.items()
                 for k in range(1, len(x)) if x[:k] in number and x[k:] in number]
        self.bits = max(4, (4 * len(found)).bit_length())
        self.keys, self.made = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        key, made = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2
        at = self._place(key)
        while len(key):
            free = np.flatnonzero(self.keys[at] < 0)
            won = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[won]], self.made[at[won]] = key[won], made[won]
            left = np.delete(np.arange(len(key)), won)
            key, made, at = key[left], made[left], (at[left] + 1) & (len(self.keys) - 1)

    def _place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or NONE, piece) of each pair."""
        key = left.astype(np.int64) * self.n + right
        at = self._place(key)
        held = self.keys[at]
        further = np.flatnonzero((held != key) & (held >= 0))  # the place has another pair
        while len(further):
            at[further] = (at[further] + 1) & (len(self.keys) - 1)
            held[further] = now = self.keys[at[further]]
            further = further[(now != key[further]) & (now >= 0)]
        made = self.made[at]
        return np.where(held == key, self.rank[made], self.NONE), made


@cache
def pairs(vocab: Vocabulary) -> _Pairs:
    return _Pairs(vocab)


def segment_all(chunks: list[str], vocab: Vocabulary, skips: np.ndarray | None = None,
                gap: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> tuple[list[bytes], np.ndarray]:
    """What ``segment`` gives for each chunk, as bytes, and how many candidates were met.

    ``skips``: the first skipped candidate of each; ``gap(rows, nth)``: how many pass after it and later ones.
    """
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
    order = np.argsort(sizes, kind="stable")
    out, met = [b""] * len(chunks), np.zeros(len(chunks), np.int64)
    for i in range(0, len(order), ROWS):
        at = order[i:i + ROWS]
        some = None if skips is None else skips[at]
        data, ends, met[at] = _segment_rows([chunks[j] for j in at.tolist()], sizes[at], pairs(vocab), some,
                                            None if gap is None else lambda rows, nth, at=at: gap(at[rows], nth))
        for j, a, b in zip(at.tolist(), [0, *ends], ends):
            out[j] = data[a:b]
    return out, met


def _segment_rows(chunks: list[str], n: np.ndarray, table: _Pairs, skip: np.ndarray | None,
                  gap: Callable[[np.ndarray, np.ndarray], np.ndarray] | None) -> tuple[bytes, list[int], np.ndarray]:
    """The ids of all chunks as bytes, where those of each end, and the candidates met."""
    width = int(n.max())
    chars = np.array(chunks, f"U{width}").view(np.uint32).reshape(-1, width)
    place, none = np.arange(width), table.NONE
    symbol, alive = table.of_char[chars], place < n[:, None]
    rank, made = np.full(chars.shape, none), np.zeros(chars.shape, np.int32)  # of the pair that starts at a place
    first, second = table.find(symbol[:, :-1].ravel(), symbol[:, 1:].ravel())
    rank[:, :-1] = np.where(alive[:, 1:], first.reshape(-1, width - 1), none)
    made[:, :-1] = second.reshape(-1, width - 1)
    # flat places; of the symbol that starts at a place, where the next one and the one before start
    after, before = np.tile(place + 1, (len(n), 1)), np.tile(place - 1, (len(n), 1))
    symbol, alive, made, after, before, flat = (x.reshape(-1) for x in (symbol, alive, made, after, before, rank))
    met, nth = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
    rows = np.arange(len(n))
    while len(rows):
        best = rank[rows].argmin(1)
        open_ = flat[rows * width + best] != none
        rows, best = rows[open_], best[open_]
        going, at = rows, best
        if skip is not None:
            hit = met[rows] == skip[rows]
            skipped = rows[hit]
            flat[skipped * width + best[hit]] = none
            nth[skipped] += 1
            skip[skipped] += 1 + gap(skipped, nth[skipped])
            going, at = rows[~hit], best[~hit]
        met[rows] += 1
        low = going * width
        here = low + at
        there = after[here]
        piece, further = made[here], after[low + there]
        symbol[here], after[here] = piece, further
        alive[low + there], flat[low + there], flat[here] = False, none, none
        on = np.flatnonzero(further < n[going])
        beside = low[on] + further[on]
        before[beside] = at[on]
        back = np.flatnonzero(before[here] >= 0)
        prior = low[back] + before[here[back]]
        found, new = table.find(np.concatenate([piece[on], symbol[prior]]), np.concatenate([symbol[beside], piece[back]]))
        to = np.concatenate([here[on], prior])
        flat[to], made[to] = found, new
    ids, of_row = table.ids[symbol[alive]], alive.reshape(-1, width).sum(1)
    other = ids < 0
    size = np.ones(len(ids), np.int64)
    if other.any():  # characters outside the vocabulary, as bytes
        lost = chars.reshape(-1)[alive][other]
        size[other] = 1 + (lost > 0x7F) + (lost > 0x7FF) + (lost > 0xFFFF)
        spelled = table.byte_ids[np.frombuffer("".join(map(chr, lost.tolist())).encode(), np.uint8)]
        ids = np.repeat(ids, size)
        ids[np.repeat(other, size)] = spelled
    ends = 4 * np.r_[0, np.cumsum(size)][np.cumsum(of_row)]
    return ids.astype("<u4").tobytes(), ends.tolist(), met


def _draw(key: int, place: int, nth: int, again: int = 0) -> int:
    """A 64-bit value of a document's key, a chunk's place and which of its draws it is."""
    return xxhash.xxh64_intdigest(struct.pack("<3I", place, nth, again), key)


def _first_draws(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """64-bit values of documents' keys and places, by the mixer of splitmix64."""
    z = (place + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + key
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return z ^ z >> np.uint64(31)


def _draws(key: np.ndarray, place: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """``_draw`` of each key, place and number: XXH64 of twelve bytes."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turned = lambda x, bits: x << np.uint64(bits) | x >> np.uint64(64 - bits)
    h = key + p5 + np.uint64(12)
    h ^= turned((place.astype(np.uint64) | nth.astype(np.uint64) << np.uint64(32)) * p2, 31) * p1
    h = turned(h, 27) * p1 + p4
    h = turned(h, 23) * p2 + p3  # the last four bytes are zero
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


def _limits(dropout: float) -> list[int]:
    """Ascending limits: as many candidates pass in a row as limits are above a draw."""
    found, chance = [], 1.0
    while len(found) < MOST_PASS and (limit := int((chance := chance * (1.0 - dropout)) * (1 << 64))):
        found.append(min(limit, (1 << 64) - 1))
    return found[::-1]


class _Segmented(dict):
    """Chunk -> (candidates met, ids as little-endian unsigned 32-bit bytes), without skips.

    Full, it becomes the older generation, from which chunks that come again are taken over.
    """

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab, self.older = vocab, {}

    def all(self, chunks: list[str]) -> list[tuple[int, bytes]]:
        """Those of distinct chunks of at most ``KEEP_CHARS``."""
        if len(self) >= KEEP:
            self.older = dict(self)
            self.clear()
        new = [x for x in chunks if x not in self]
        unknown = [x for x in new if x not in self.older]
        self.update((x, self.older[x]) for x in new if x in self.older)
        ids, met = segment_all(unknown, self.vocab)
        self.update(zip(unknown, zip(met.tolist(), ids)))
        return [self[x] for x in chunks]


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


@cache
def coder(model: str = "piece_bpe_32k.model", dropout: float = DROPOUT, seed: int = SEED) -> MergeDropout:
    """One for a worker process, whose tasks share its dictionaries."""
    return MergeDropout(model, dropout, seed)


class MergeDropout:
    """``encode(text, key)``: ids as bytes; ``decode(ids)``: the text."""

    def __init__(self, model: str = "piece_bpe_32k.model", dropout: float = DROPOUT, seed: int = SEED):
        self.vocab, self.seed, self.dropout = vocabulary(model), seed, dropout
        self.table = _Segmented(self.vocab)
        self.limits = _limits(dropout)
        self.limit_array, self.most = np.array(self.limits, np.uint64), len(self.limits)

    def encode(self, text: str, key: int = 0) -> bytes:
        return self.encode_all([text], [key])[0]

    def encode_all(self, texts: list[str], keys: list[int]) -> list[bytes]:
        out, low, chars = [], 0, 0
        for i, text in enumerate(texts):
            chars += len(text)
            if chars >= CHARS or i + 1 == len(texts):
                out += self._encoded(texts[low:i + 1], keys[low:i + 1])
                low, chars = i + 1, 0
        return out

    def _encoded(self, texts: list[str], keys: list[int]) -> list[bytes]:
        split = [_chunks(text) for text in texts]
        index = {x: i for i, x in enumerate(dict.fromkeys(chain.from_iterable(split)))}
        chunks = list(index)
        small = [x for x in chunks if len(x) <= KEEP_CHARS]
        # longer chunks are rare, and each occurrence is segmented by itself
        plain = dict(zip(small, self.table.all(small)))
        plain = [plain.get(x, (-1, b"")) for x in chunks]
        at = np.fromiter(map(index.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        out = [plain[i][1] for i in at.tolist()]
        met = np.array([x[0] for x in plain], np.int64)[at]
        sizes = [len(x) for x in split]
        starts = np.cumsum([0, *sizes])
        keyed = np.array([xxhash.xxh64_intdigest(k.to_bytes(8, "little", signed=True), self.seed) for k in keys], np.uint64)
        place = np.arange(len(at)) - np.repeat(starts[:-1], sizes)
        if self.dropout:
            passed = self._passed(_first_draws(np.repeat(keyed, sizes), place))
            skipping = np.flatnonzero(passed < met)
            owner, where = np.repeat(keyed, sizes)[skipping], place[skipping]
            found, _ = segment_all([chunks[i] for i in at[skipping].tolist()], self.vocab, passed[skipping],
                                   lambda rows, nth: self._passed(_draws(owner[rows], where[rows], nth)))
            for i, ids in zip(skipping.tolist(), found):
                out[i] = ids
        for i in np.flatnonzero(met < 0).tolist():
            doc = int(np.searchsorted(starts, i, "right")) - 1
            skips = self._skips(int(keyed[doc]), int(place[i]), int(passed[i])) if self.dropout else iter(())
            out[i] = pack(segment(chunks[at[i]], self.vocab, skips)[0])
        return [b"".join(out[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]

    def _passed(self, draws: np.ndarray) -> np.ndarray:
        """How many candidates pass by each draw."""
        return self.most - np.searchsorted(self.limit_array, draws, "right")

    def _skips(self, key: int, place: int, passed: int) -> Iterator[int]:
        """The skipped candidates of a place, without end; ``passed``: by its first draw."""
        at, nth = 0, 0
        while True:
            again = 0
            at += passed
            while passed == self.most == MOST_PASS:  # so many pass and more may
                again += 1
                passed = self.most - bisect_right(self.limits, _draw(key, place, nth, again))
                at += passed
            yield at
            at, nth = at + 1, nth + 1
            passed = self.most - bisect_right(self.limits, _draw(key, place, nth))

    def decode(self, ids: bytes) -> str:
        spelled = self.vocab.spelled
        return b"".join([spelled[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode()[1:]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return narrow(docs, id_col, text_col, F.xxhash64(F.col(id_col)).alias("key"))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = "piece_bpe_32k.model",
           dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(doc_id, ids): one row per input row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(model, dropout, seed)
        for b in slices(batches):
            found = [np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode_all(texts(b), b.column("key").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _keyed(docs, id_col, text_col).mapInArrow(run, f"doc_id {id_type(docs, id_col)}, ids array<int>")


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = "piece_bpe_32k.model") -> DataFrame:
    """(doc_id, text): the texts of ``encode``; null ids count as none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(model, 0.0)
        for b in slices(batches):
            found = [bpe.decode(pack(x or [])) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, pa.string())], names=["doc_id", "text"])

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {id_type(encoded, id_col)}, text string")


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = "piece_bpe_32k.model",
                dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, n_bytes, lossless): each text encoded, decoded and compared."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(model, dropout, seed)
        for b in slices(batches):
            out = []
            rows = texts(b)
            for text, ids in zip(rows, bpe.encode_all(rows, b.column("key").to_pylist()), strict=True):
                out.append((len(ids) // 4, zlib.crc32(ids), len(text.encode()), bpe.decode(ids) == text))
            if out:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *map(pa.array, zip(*out, strict=True))],
                                                 names=["doc_id", "n_ids", "ids_crc32", "n_bytes", "lossless"])

    return _keyed(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {id_type(docs, id_col)}, n_ids long, ids_crc32 long, n_bytes long, lossless boolean")
