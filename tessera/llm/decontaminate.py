"""Benchmark decontamination as a prefix-filtered set join of windows.

An item is cut into windows of ``size`` consecutive words (a shorter item is one window); a window
is the set of its shingles of ``SHINGLE`` words with their places. A window occurs in a document
where at least ``share`` of its shingles stand at their places, all of them by default.

1. Rarity: one scan counts how often each shingle of the windows occurs in the documents.
2. Prefix: a window's shingles are ordered by rarity. Where it occurs, one of its
   ``m - ceil(share * m) + 1`` rarest shingles is found (the rarest one for whole windows), so only
   these are joined. Length bound: a window with too few shingles that occur at all is dropped.
3. Join: a second scan emits the places of prefix shingles with the words around them, and they
   are joined by the shingle's hash. Positional bound: the window, placed by its shingle, has to lie
   inside the document.
4. Verification compares the words themselves, over a stretch of the window's size.

Both scans drop other shingles by a filter whose size follows from a count (``members``); the joins
decide. No documents' texts are shuffled, only the words around prefix shingles. A passage that a
third of all documents hold is a hot key on the documents' side only: the other side has one row for
each window and prefix shingle, so Spark can split the key. Items are looked up once for each
distinct set of windows that a document holds, not for each document.

Words: after A-Z are lower-cased, runs of ASCII letters, digits and anything outside ASCII. Null and
empty texts hold no words and no windows; a null item id counts as the empty string; rows that
repeat an item id are one item with the windows of all of them. Each row of the documents gives one
row, rows that repeat an id too, each judged by its own text. Other columns are not read; an empty
table of documents gives an empty result, an empty benchmark finds nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, id_type, narrow, slices
from tessera.llm.members import holds, key_filter

SIZE = 10
SHINGLE = 3
#: Distinct keys that a task sums before it hands them on.
KEEP = 1_000_000
#: Words whose hash a task keeps; the dictionary is cleared when full.
KEEP_WORDS = 500_000
_LETTERS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_LETTERS).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEEP_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingle_keys(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit key for each ``k`` consecutive words; keys of another ``k`` differ."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = (h ^ hashes[i:i + n]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def _bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def item_windows(items: DataFrame, size: int, shingle: int, item_col: str, text_col: str) -> DataFrame:
    """(item, window, n, keys): the words of each window, space-joined, and the keys of its shingles."""
    def run(batches):
        known = _Hashes()
        for batch in slices(batches):
            out = []
            for item, text in zip(batch.column("item").to_pylist(), _bytes(batch)):
                words = words_of(text)
                n = min(size, len(words))
                if n:
                    keys = shingle_keys(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), min(shingle, n)).view(np.int64)
                    out += [(item, b" ".join(words[i:i + n]).decode(), n, keys[i:i + n - min(shingle, n) + 1])
                            for i in range(len(words) - n + 1)]
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()),
                pa.array([x[2] for x in out], pa.int32()), pa.array([x[3] for x in out], pa.list_(pa.int64()))], ["item", "window", "n", "keys"])

    rows = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "item string, window string, n int, keys array<long>")


def _scan(batches: Iterator[pa.RecordBatch], lengths: list[int], bits: np.ndarray | None):
    """(batch, words of all its rows, the rows' first words, places of wanted shingles, their keys)."""
    known = _Hashes()
    for batch in slices(batches):
        split = [words_of(x) for x in _bytes(batch)]
        first = np.concatenate([[0], np.cumsum([len(x) for x in split], dtype=np.int64)])
        words = [w for x in split for w in x]
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        last = np.repeat(first[1:], np.diff(first))  # the end of each word's row
        places, keys = [], []
        for k in lengths:
            found = shingle_keys(hashes, k)
            at = np.flatnonzero(holds(bits, found))
            at = at[at + k <= last[at]]
            places.append(at)
            keys.append(found[at])
        yield batch, words, first, np.concatenate(places), np.concatenate(keys)


def shingle_counts(docs: DataFrame, lengths: list[int], bits: np.ndarray | None) -> DataFrame:
    """(key, found): occurrences of the shingles that pass the filter, summed in each task first."""
    def run(batches):
        kept, sums, size = [], [], 0

        def flush():
            k, inverse = np.unique(np.concatenate(kept), return_inverse=True)
            n = np.zeros(len(k), np.int64)
            np.add.at(n, inverse, np.concatenate(sums))
            return k, n

        for _, _, _, _, keys in _scan(batches, lengths, bits):
            k, n = np.unique(keys, return_counts=True)
            kept.append(k)
            sums.append(n)
            size += len(k)
            if size > KEEP:
                k, n = flush()
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], ["key", "found"])
                kept, sums, size = [], [], 0
        if kept:
            k, n = flush()
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], ["key", "found"])

    return docs.select("text").mapInArrow(run, "key long, found long").groupBy("key").agg(F.sum("found").alias("found"))


def prefixes(windows: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """(key, place, window, n): the rarest shingles of each window that can occur at all."""
    shingles = windows.select("window", "n", F.posexplode("keys").alias("place", "key"))
    rated = (shingles.join(counts, "key", "left").groupBy("window", "n")
             .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("found", F.lit(0).cast("long")).alias("found"), "key", "place"))).alias("s")))
    need = F.ceil(F.size("s") * F.lit(share)).cast("int")
    rated = rated.filter(F.size(F.filter("s", lambda x: x["found"] > 0)) >= need)
    rated = rated.select("window", "n", F.explode(F.slice("s", F.lit(1), F.size("s") - need + 1)).alias("x"))
    return rated.filter("x.found > 0").select(F.col("x.key").alias("key"), F.col("x.place").alias("place"), "window", "n")


def _rows_with_hits(docs: DataFrame, id_sql: str, lengths: list[int], bits: np.ndarray | None, size: int) -> DataFrame:
    """(doc_id, n_words, hits): a row per document with the places of prefix shingles and the words around them."""
    hit = pa.struct([("key", pa.int64()), ("at", pa.int64()), ("from", pa.int64()), ("around", pa.string())])

    def run(batches):
        for batch, words, first, places, keys in _scan(batches, lengths, bits):
            row = np.searchsorted(first, places, "right") - 1
            out: list[list] = [[] for _ in range(batch.num_rows)]
            for r, p, key in zip(row.tolist(), places.tolist(), keys.view(np.int64).tolist()):
                start, end = int(first[r]), int(first[r + 1])
                low = max(start, p - size + 1)
                out[r].append({"key": key, "at": p - start, "from": low - start,
                               "around": b" ".join(words[low:min(end, p + size)]).decode()})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(first)), pa.array(out, pa.list_(hit))],
                                             ["doc_id", "n_words", "hits"])

    return docs.mapInArrow(run, f"doc_id {id_sql}, n_words long, hits array<struct<key: long, at: long, `from`: long, around: string>>")


def _same_shingles(a, b, k):
    """Shingles of ``b`` that ``a`` has at the same place; both are arrays of words."""
    return F.size(F.filter(F.sequence(F.lit(1), F.size(b) - k + 1), lambda i: F.slice(a, i, k) == F.slice(b, i, k)))


def _covered(spans):
    """Words inside any of the (start, n) of an array."""
    def step(a, x):
        end = x["start"] + x["n"]
        return F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(a["end"], x["start"]))).alias("n"),
                        F.greatest(a["end"], end).alias("end"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(F.sort_array(spans), zero, step)["n"]


def contamination(docs: DataFrame, items: DataFrame, size: int = SIZE, shingle: int = SHINGLE, share: float = 1.0,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items): one row per input row.

    ``spans`` are the distinct (start, n) words that windows occupy in the document, in order;
    ``items`` the ids, as sorted strings, of the items that own one of those windows.
    """
    if not 0 < share <= 1 or size < 1 or shingle < 1:
        raise ValueError("share lies in (0, 1], size and shingle are at least 1")
    owned = cut(item_windows(items, size, shingle, item_col, item_text_col).distinct())
    windows = owned.select("window", "n", "keys").distinct()
    lengths = sorted(r[0] for r in windows.select(F.least("n", F.lit(shingle))).distinct().collect())  # at most ``shingle`` values
    source = narrow(docs, id_col, text_col)
    wanted = cut(windows.select(F.explode("keys").alias("key")).distinct())
    counts = shingle_counts(source, lengths, key_filter(wanted, "key")) if lengths else wanted.select("key", F.lit(0).cast("long").alias("found"))
    prefix = cut(prefixes(windows, counts, share))
    bits = key_filter(cut(prefix.select("key").distinct()), "key")
    # written once, so that a row's number stays what it is
    rows = cut(_rows_with_hits(source, id_type(docs, id_col), lengths or [shingle], bits, size).withColumn("uid", F.monotonically_increasing_id()))

    hits = rows.select("uid", F.explode("hits").alias("h")).select("uid", "h.*")
    k = F.least("n", F.lit(shingle))
    start = F.col("at") - F.col("place")
    placed = (hits.join(prefix, "key")
              .withColumn("start", start).filter("start >= `from`")
              .withColumn("here", F.slice(F.split("around", " "), F.greatest(F.col("start") - F.col("from") + 1, F.lit(1)).cast("int"), F.col("n")))
              .filter(F.size("here") == F.col("n")))
    there = F.split("window", " ")
    if share == 1:
        same = F.col("here") == there
    else:
        m = F.col("n") - k + 1
        same = _same_shingles(F.col("here"), there, k) >= F.ceil(m * F.lit(share))
    found = placed.filter(same).select("uid", "start", F.col("n").cast("long").alias("n"), F.md5("window").alias("window"))
    each = (found.groupBy("uid").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("spans"),
                                     F.sort_array(F.collect_set("window")).alias("windows"))
            .select("uid", "spans", _covered(F.col("spans")).alias("n_hit"), "windows", F.sha2(F.concat_ws(",", "windows"), 256).alias("held")))
    each = cut(each)
    owners = owned.select(F.md5("window").alias("window"), "item").distinct()
    sets = (each.select("held", "windows").dropDuplicates(["held"]).select("held", F.explode("windows").alias("window"))
            .join(owners, "window").groupBy("held").agg(F.sort_array(F.collect_set("item")).alias("items")))
    each = each.join(sets, "held").select("uid", "spans", "n_hit", "items")
    none = F.array().cast("array<struct<start: long, n: long>>")
    return (rows.select("uid", "doc_id", "n_words").join(each, "uid", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("spans", none).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def contaminated_share(found: DataFrame) -> DataFrame:
    """(item, n_docs): how many documents hold each item that was found, with map-side sums."""
    return found.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n_docs"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of any item, with all their columns.

    A text is judged once however many rows hold it; texts are told apart by their SHA-256.
    """
    tagged = docs.withColumn("_dc_text", F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
    texts = tagged.select(F.col("_dc_text").alias("doc_id"), F.col(text_col).cast("string").alias("text")).dropDuplicates(["doc_id"])
    bad = contamination(texts, items, **how).filter("n_hit > 0").select(F.col("doc_id").alias("_dc_text"))
    return tagged.join(bad, "_dc_text", "left_anti").drop("_dc_text")
