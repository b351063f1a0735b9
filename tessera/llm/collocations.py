"""Phrase collocations by multikey three-way quicksort of suffix pointers.

A text is cut into pieces at punctuation and line ends, and a piece into words. A suffix points at a
word and reaches ``max_words`` words far inside its piece. Sorting the suffixes word by word puts
equal phrases together, and the size of an equal partition is the phrase's count.

1. Words are counted per language. A word below ``min_count`` is in no frequent phrase, so it ends
   pieces from here on; so does, after a count of the neighbouring pairs, every pair below it. Both
   sets travel as filters whose size follows from a count (``members``); what a filter lets through by
   mistake, or because there are too many keys for one, only costs time.
2. The suffixes that are left, of two words or more, are routed by their leading word. Where a word
   occurs more than ``max_group`` times, two leading words route them, so no task sorts more than
   ``max_group`` of a kind. Under a pair that is more frequent still, each task sums the prefixes of its
   suffixes, and the sums are routed prefix by prefix.
3. Each bucket's suffixes are sorted by three-way partitions at growing depth. A partition whose
   occurrences add up to less than ``min_count`` is abandoned.
4. Each phrase is scored at its weakest cut, by joins with the counts of both parts, in exact
   decimals; phrases that a longer one covers are dropped, and the best of each language stay.

Pairs and suffixes are summed in each task and shuffled as sorted, compressed blocks, a row per block
and bucket; see ``blocks``.

Words are bytes other than blanks and tabs, in A-Z lower-cased text; pieces end at ``.,;:!?`` and the
characters 10 to 13. A null text counts as empty, a null language as ``und``. Rows that repeat each
other all count. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import by_bucket, count_keys, dealt, grow, n_buckets, numbers_of, planes, shrink
from tessera.llm.common import cut, slices
from tessera.llm.members import holds, key_filter

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
#: A phrase is dropped when a longer one has at least this share of its occurrences.
COVER_PERCENT = 100
#: Occurrences of a leading word, or pair, beyond which more leading words route the suffixes.
MAX_GROUP = 200_000
#: Rows that a task sums at a time.
KEEP = 1_000_000
#: Languages whose totals are broadcast, 1 MB at most.
MANY_LANGS = 10_000
#: Bits of a pair's key. Pairs that share a key only pass the filter together.
PAIR_BITS = 48
#: Distinct words of a task's dictionary; it is begun again beyond. Squared and multiplied by KEEP it fits 63 bits.
KEEP_WORDS = 500_000
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_PIECES = bytes.maketrans(_BREAKS + b"\t", b"\n" * len(_BREAKS) + b" ")
_BLANKS = bytes.maketrans(_BREAKS + b"\t", b" " * (len(_BREAKS) + 1))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BREAK, _NOTHING = 0, 1


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """The texts of each language in a slice as one text, in lower case."""
    for batch in slices(batches):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            if text:
                texts.setdefault(lang, []).append(text)
        for lang, found in texts.items():
            yield lang, b"\n".join(found).lower()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n); the null word holds the number of all words."""
    def run(batches):
        counts: dict[str, Counter] = {}

        def rows():
            for lang, c in counts.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * (len(c) + 1)), pa.array([None, *map(bytes.decode, c)], pa.string()),
                    pa.array([sum(c.values()), *c.values()], pa.int64())], ["lang", "word", "n"])

        for lang, text in _by_lang(batches):
            counts.setdefault(lang, Counter()).update(text.translate(_BLANKS).split())
            if sum(map(len, counts.values())) > KEEP:
                yield from rows()
                counts.clear()
        yield from rows()

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang)


def _word_key(word: bytes, seed: int) -> int:
    return max(xxhash.xxh3_64_intdigest(word, seed), 2)


def word_keys(words: DataFrame) -> DataFrame:
    """(key) of each (lang, word)."""
    def run(batches):
        for batch in batches:
            keys = [_word_key(w, _seed(lang)) for lang, w in zip(batch.column("lang").to_pylist(), batch.column("word").cast(pa.binary()).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64))], ["key"])

    return words.select("lang", "word").mapInArrow(run, "key long")


class _Words(dict):
    """Word -> its number in this task; ``keys`` has the 64-bit key of each number."""

    def __init__(self, lang: str):
        super().__init__({b"\n": _BREAK, b"": _NOTHING})
        self.seed, self.keys = _seed(lang), [0, 0]

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self.keys)
        self.keys.append(_word_key(word, self.seed))
        return found


def _numbers(text: bytes, known: _Words) -> tuple[np.ndarray, list[bytes]]:
    """A number for each word and for each end of a piece, and the words themselves."""
    words = text.translate(_PIECES).replace(b"\n", b" \n ").split(b" ")
    numbers = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    at = np.flatnonzero(numbers != _NOTHING)
    return numbers[at], [words[i] for i in at.tolist()] if len(at) < len(words) else words


def _pairs(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The key of each word with its neighbour where both are wanted, else 0; ``PAIR_BITS`` bits."""
    h = (keys[:-1] * _MIX) ^ keys[1:]
    h = (h ^ (h >> np.uint64(29))) * _MIX
    h >>= np.uint64(64 - PAIR_BITS)
    h[h == 0] = 1
    return np.where(wanted[:-1] & wanted[1:], h, np.uint64(0))


def _scan(batches, bits: np.ndarray | None):
    """(lang, dictionary, numbers, pair keys) of a slice's texts of one language."""
    known: dict[str, _Words] = {}
    for lang, text in _by_lang(batches):
        d = known.get(lang)
        if d is None or len(d) > KEEP_WORDS:
            d = known[lang] = _Words(lang)
        numbers, words = _numbers(text, d)
        keys = np.array(d.keys, np.uint64)
        wanted = holds(bits, keys)
        wanted[:2] = False
        yield lang, d, numbers, words, _pairs(keys[numbers], wanted[numbers])


def pair_counts(docs: DataFrame, word_bits: np.ndarray | None, least: int) -> DataFrame:
    """(pair, n): keys of neighbouring words that both pass the filter and occur together ``least`` times or more."""
    def keys(batches):
        for *_, pairs in _scan(batches, word_bits):
            yield pairs[pairs != 0]

    return count_keys(docs, keys, least, PAIR_BITS, KEEP).withColumnRenamed("key", "pair")


def _equal_rows(columns: np.ndarray, base: int) -> np.ndarray:
    """A number for each row (column of the matrix) that equal rows share; exact."""
    rank = np.unique(columns[0] * base + columns[1], return_inverse=True)[1]
    for i in range(2, len(columns)):
        rank = np.unique(rank * base + columns[i], return_inverse=True)[1]
    return rank


def suffixes(docs: DataFrame, word_bits: np.ndarray | None, pair_bits: np.ndarray | None, hot_words: np.ndarray | None,
             hot_pairs: np.ndarray | None, max_words: int) -> DataFrame:
    """(bucket, lang, whole, size, bytes, block): suffixes of two words or more up to a pair that fails the filter.

    Equal ones of a slice are summed. A block holds sorted phrases and their counts. ``whole`` blocks
    have prefixes under the most frequent pairs, which are phrases by themselves.
    """
    buckets = n_buckets(docs)

    def rows(lang, d, parts):
        numbers, pairs = np.concatenate([x[0] for x in parts], axis=1), np.concatenate([x[1] for x in parts])
        rank = _equal_rows(numbers, len(d.keys) + 1)
        _, first = np.unique(rank, return_index=True)
        numbers, pairs, counts = numbers[:, first], pairs[first], np.bincount(rank).tolist()
        keys = np.array(d.keys, np.uint64)[numbers[0]]
        bucket = (np.where(holds(hot_words, keys), pairs, keys) % np.uint64(buckets)).tolist()
        names, found, prefixes = list(d), {}, Counter()
        for row, to, hot, n in zip(numbers.T.tolist(), bucket, holds(hot_pairs, pairs).tolist(), counts):
            words = [names[x] for x in row if x]
            if hot:
                for k in range(2, len(words) + 1):
                    prefixes[b" ".join(words[:k])] += n
            else:
                found.setdefault((to, False), []).append((b" ".join(words), n))
        for phrase, n in prefixes.items():
            found.setdefault((xxhash.xxh3_64_intdigest(phrase, d.seed) % buckets, True), []).append((phrase, n))
        out = []
        for (to, whole), listed in found.items():
            listed.sort()
            text, counted = b"\n".join([x[0] for x in listed]), planes(np.array([x[1] for x in listed]))
            out.append((to, lang, whole, len(listed), len(text) + len(counted), shrink(counted + text)))
        types = [pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(types)],
                                          ["bucket", "lang", "whole", "size", "bytes", "block"])

    def run(batches):
        waiting: dict[str, tuple] = {}
        for lang, d, numbers, _, pairs in _scan(batches, word_bits):
            if lang in waiting and (waiting[lang][0] is not d or sum(len(x[1]) for x in waiting[lang][1]) > KEEP):
                yield rows(lang, *waiting.pop(lang))
            linked = (pairs != 0) & holds(pair_bits, pairs)
            at = np.flatnonzero(linked)
            if not len(at):
                continue
            found = np.zeros((max_words, len(at)), np.int64)
            found[0], found[1] = numbers[at], numbers[at + 1]
            alive = np.ones(len(at), bool)
            linked = np.r_[linked, np.zeros(max_words, bool)]
            numbers = np.r_[numbers, np.zeros(max_words, np.int64)]
            for k in range(2, max_words):
                alive &= linked[at + k - 1]
                found[k] = np.where(alive, numbers[at + k], 0)
            waiting.setdefault(lang, (d, []))[1].append((found, pairs[at]))
        for lang, x in waiting.items():
            yield rows(lang, *x)

    return docs.mapInArrow(run, "bucket int, lang string, whole boolean, size long, bytes long, block binary")


def multikey_quicksort(columns: np.ndarray, weights: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(a row, depth, weight) for each equal partition of at least ``least``: rows that agree on the first ``depth`` + 1 columns.

    Columns hold numbers; a negative number ends a row. Pointers to rows are divided into smaller,
    equal and larger by one column, the equal ones go on to the next; partitions of a smaller
    weight are abandoned. The stack replaces the recursion.
    """
    out, stack = [], [(np.arange(len(weights)), 0)]
    while stack:
        at, depth = stack.pop()
        if weights[at].sum() < least:
            continue
        keys = columns[depth][at]
        pivot = keys[len(keys) // 2]
        low, high = at[keys < pivot], at[keys > pivot]
        if len(low):
            stack.append((low, depth))
        if len(high):
            stack.append((high, depth))
        same = at[keys == pivot] if len(low) or len(high) else at
        total = int(weights[same].sum())
        if pivot >= 0 and total >= least:
            out.append((int(same[0]), depth, total))
            if depth + 1 < len(columns):
                stack.append((same, depth + 1))
    return out


def _sorted_counts(langs: pa.Array, phrases: pa.Array, weights: np.ndarray, max_words: int, least: int) -> list[tuple]:
    """(lang, phrase, n) of the prefixes of two words or more with at least ``least`` occurrences."""
    split = pc.split_pattern(phrases, " ")
    lengths = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    codes = pc.list_flatten(split).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    first = np.cumsum(lengths) - lengths
    columns = np.full((max_words + 1, len(lengths)), -1, np.int32)
    columns[0] = langs.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    for k in range(max_words):
        has = lengths > k
        columns[k + 1][has] = codes[first[has] + k]
    found = [x for x in multikey_quicksort(columns, weights, least) if x[1] >= 2]
    at = pa.array([x[0] for x in found], pa.int64())
    return [(lang, " ".join(p.split(" ")[:x[1]]), x[2]) for lang, p, x in zip(langs.take(at).to_pylist(), phrases.take(at).to_pylist(), found)]


def sort_suffixes(blocks: DataFrame, max_words: int, least: int) -> DataFrame:
    """(lang, phrase, n): phrases of two words or more with at least ``least`` occurrences, bucket by bucket."""
    def run(batches):
        for rows in by_bucket(batches):
            sums, langs, phrases, weights = Counter(), [], [], []
            for r in rows:
                data, n = grow(r["block"], r["bytes"]), r["size"]
                listed, counted = data[8 * n:].decode().split("\n"), numbers_of(data[:8 * n]).astype(np.int64)
                if r["whole"]:
                    for phrase, k in zip(listed, counted.tolist()):
                        sums[r["lang"], phrase] += k
                else:
                    langs += [r["lang"]] * n
                    phrases += listed
                    weights.append(counted)
            out = [(*x, n) for x, n in sums.items() if n >= least]
            if phrases:
                out += _sorted_counts(pa.array(langs, pa.string()), pa.array(phrases, pa.string()), np.concatenate(weights), max_words, least)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                                             ["lang", "phrase", "n"])

    return dealt(blocks).mapInArrow(run, "lang string, phrase string, n long")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, max_group: int = MAX_GROUP,
                  lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, n_words, n): phrases of 1 to ``max_words`` words with at least ``min_count`` occurrences.

    The row with a null phrase and 0 words has the number of all words of its language.
    """
    if min_count < 1 or max_words < 2:
        raise ValueError("min_count is at least 1, max_words at least 2")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = cut(word_counts(rows).filter((F.col("n") >= min_count) | F.col("word").isNull()))
    known = words.filter("word IS NOT NULL")
    word_bits = key_filter(cut(word_keys(known)), "key")
    hot_words = key_filter(cut(word_keys(known.filter(F.col("n") > max_group))), "key")
    pairs = cut(pair_counts(rows, word_bits, min_count))
    pair_bits, hot_pairs = key_filter(pairs, "pair"), key_filter(pairs.filter(F.col("n") > max_group), "pair")
    found = sort_suffixes(suffixes(rows, word_bits, pair_bits, hot_words, hot_pairs, max_words), max_words, min_count)
    return cut(words.select("lang", F.col("word").alias("phrase"), F.when(F.col("word").isNull(), 0).otherwise(1).alias("n_words"), "n")
               .unionByName(found.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("n_words"), "n")))


def _parts(w, n):
    """All shorter phrases of two words or more inside the ``n`` words ``w``."""
    return F.flatten(F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.transform(
        F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))))


def score(counts: DataFrame) -> DataFrame:
    """(lang, phrase, n_words, a, l, r, n, score): each phrase of two words or more at its weakest cut."""
    known = counts.filter("n_words > 0")
    part = lambda name, value: known.select("lang", F.col("phrase").alias(name), F.col("n").alias(value))
    total = cut(counts.filter("n_words = 0").select("lang", F.col("n").alias("total")))
    if total.count() <= MANY_LANGS:  # else the join by language, which a common language makes uneven
        total = F.broadcast(total)
    cuts = (known.filter("n_words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
            .withColumn("first", F.array_join(F.slice(F.split("phrase", " "), F.lit(1), F.col("k")), " "))
            .withColumn("rest", F.array_join(F.slice(F.split("phrase", " "), F.col("k") + 1, F.col("n_words")), " ")))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(total, "lang")
    exact = F.expr("(cast(1000 as decimal(4, 0)) * cast(n as decimal(15, 0)) * cast(total as decimal(15, 0)))"
                   " div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0)))")
    return (cuts.withColumn("score", exact).groupBy("lang", "phrase", "n_words", F.col("n").alias("a"), F.col("total").alias("n"))
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
            .select("lang", "phrase", "n_words", "a", "w.l", "w.r", "n", "w.score"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 cover_percent: int = COVER_PERCENT, max_group: int = MAX_GROUP, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    counts = phrase_counts(docs, min_count, max_words, max_group, lang_col, text_col)
    longer = counts.filter("n_words > 2")
    covers = (longer.select("lang", F.explode(_parts(F.split("phrase", " "), F.col("n_words"))).alias("phrase"), "n")
              .groupBy("lang", "phrase").agg(F.max("n").alias("cover")))
    left = (score(counts).join(covers, ["lang", "phrase"], "left")
            .filter(F.col("cover").isNull() | (100 * F.col("cover") < cover_percent * F.col("a"))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
