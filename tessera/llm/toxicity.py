"""Toxicity of restored text: noisy-channel deobfuscation, then a logistic regression on words.

Source model: a character language model, counted over the letters of all documents. Channel:
a written character may stand for letters (leetspeak), may be a separator between letters of a
word, may be noise, or may repeat a letter. The readings of a written token, or of a run of
single characters, form a lattice; Viterbi decoding finds the reading that is likeliest under
both. Tokens whose only reading is themselves (letters, none doubled) are not decoded; a token
without a letter is read as a word only where that is likelier than characters by chance. Scores
depend on the restored
words of a whole text and on nothing else.

Training: a bounded sample of labelled rows that are not held out (``TRAIN_ROWS``), equal texts
once; words and beginnings of words that tell the labels apart (``FEATURES`` at most) are
weighted by a logistic regression on how many distinct words of a text have them. The model is a table of fixed size: ``SYMBOLS ** ORDER`` log-probabilities and the
weights.

Null and empty texts have no words and get the score of the intercept. Without labels of both
kinds the score is the smoothed share of label 1. Null labels are left out, null ids have no
label, and rows that repeat are scored each. Other columns are not read by ``score`` and pass
unchanged through ``drop_toxic``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, id_type, narrow, slices, texts

#: Word border, a to z, any other letter.
SYMBOLS = 28
ORDER = 4
TRAIN_ROWS = 20_000
FEATURES = 400
#: Letters of the beginnings of words that are features beside the words.
STEMS = (4, 5, 6, 7)
MIN_Z = 3.5
MIN_DOCS = 3
KEEP = 250_000
KEEP_CHARS = 64
#: Letters that a written character may stand for; fixed values of leetspeak.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "<": "c", "#": "h", "€": "e", "£": "l",
        "*": "abcdefghijklmnopqrstuvwxyz"}
SEPARATORS = set(".,-_~'/:;=^&%`\"\\)>[]{}?·•")
#: Costs of the channel, as natural logarithms.
STANDS_FOR, NOISE, SEPARATOR, BORDER, ONCE, TWICE = -1.0, -7.0, -0.5, -2.5, -8.0, -0.5
#: Cost of a character without a letter that stands for itself: one symbol of SYMBOLS by chance.
ITSELF = -float(np.log(SYMBOLS))
#: Stars in a row that each may stand for another letter; the contexts grow 26-fold with each.
STARS = 3
_EITHER = ".,;:?\"'%&~…-_=^/\\·•"
_LEFT, _RIGHT = _EITHER + "[{>", _EITHER + ")]}!"
_NOISE_RUN = re.compile(r"([^\w\s])\1{2,}$|^([^\w\s])\2{2,}|[*#]{2,}$|^[*#]{2,}")
_STAR_RUN = re.compile(r"(?<!\*)\*{1,%d}$|^\*{1,%d}(?!\*)" % (STARS, STARS))
_TWICE = re.compile(r"(\w)\1")
_DOUBLED = re.compile(r"(\w)\1(\w)\2(\w)\3")
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]+\S){2,}(?!\S)")
_LETTER = re.compile(r"[a-z]")


def _symbol_map() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[ord("a"):ord("z") + 1] = np.arange(1, 27)
    table[0x80:0xC0] = 255  # continuation bytes
    table[0xC0:] = 27
    return table


_SYMBOL = _symbol_map()


def symbols(text: str) -> np.ndarray:
    """The text's letters as symbols, each word between ORDER - 1 borders."""
    found = _SYMBOL[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    found = found[found != 255]
    found = found[np.r_[True, (found[1:] != 0) | (found[:-1] != 0)]]
    return np.repeat(found, np.where(found == 0, ORDER - 1, 1)).astype(np.int32)


def gram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, n): how often each run of ORDER symbols occurs in all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** ORDER, np.int64)
        for b in slices(batches):
            s = symbols("\n".join(texts(b)))
            grams = np.zeros(max(0, len(s) - ORDER + 1), np.int32)
            for i in range(ORDER):
                grams = grams * SYMBOLS + s[i:i + len(grams)]
            total += np.bincount(grams, minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["gram", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "gram int, n long")
    return rows.groupBy("gram").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame, weight: float = 8.0) -> np.ndarray:
    """Log-probability of a symbol after ORDER - 1 others, by interpolation over shorter contexts.

    At most SYMBOLS ** ORDER counts come to the driver, whatever the corpus.
    """
    rows = counts.toPandas()
    c = np.zeros(SYMBOLS ** ORDER)
    c[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    c = c.reshape((SYMBOLS,) * ORDER)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for n in range(1, ORDER + 1):
        seen = c.sum(axis=tuple(range(ORDER - n)))
        p = (seen + weight * p) / (seen.sum(-1, keepdims=True) + weight)
    return np.log(p).astype(np.float32).ravel()


class Restorer:
    """Restores the words of a text under a character language model."""

    def __init__(self, log_p: np.ndarray):
        self.log_p = array("f", log_p.tobytes())
        self.contexts = SYMBOLS ** (ORDER - 1)
        self.endings = self._endings(log_p.reshape(-1, SYMBOLS).astype(float))

    def _endings(self, log_p: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By number of stars at the end, for each context: the best log-probability of the rest, and
        the first star's letter there (1 to 26, 0: a border, 27: nothing)."""
        at, found = np.arange(self.contexts), [(np.where(np.arange(self.contexts) > 0, log_p[:, 0], 0.0), np.zeros(self.contexts, int))]
        following = (at[:, None] * SYMBOLS + np.arange(1, 27)) % self.contexts
        for _ in range(STARS):
            rest = found[-1][0]
            options = np.c_[NOISE + np.where(at > 0, log_p[:, 0], 0.0) + rest[0], STANDS_FOR + log_p[:, 1:27] + rest[following], NOISE + rest]
            found.append((options.max(1), options.argmax(1)))
        return found

    def _readings(self, written: str, n: int, doubled: bool) -> list[tuple[str, float]]:
        """What ``n`` of a character may read as, with its cost; a border is a space.

        In a token whose characters are doubled a pair is one letter, else it hardly ever is.
        """
        if written.isalpha():
            if n == 1:
                return [(written, 0.0)]
            if doubled and n % 2 == 0:
                return [(written * (n // 2), 0.0), *([(written, ONCE)] if n > 2 else [])]
            once, twice = (ONCE, 0.0) if n == 2 else (0.0, TWICE)
            return [(written, once), (written * 2, twice)]
        found = [(x * r, STANDS_FOR + (ONCE if n == 2 and r == 1 else 0.0)) for x in LEET.get(written, "") for r in ((1,) if n == 1 else (1, 2))]
        if not written.isdigit():
            found.append(("", SEPARATOR if written in SEPARATORS else NOISE))
        return [*found, (" ", BORDER if written in SEPARATORS else NOISE)]

    def decode(self, written: str, spaced: bool = False) -> str:
        """The likeliest reading; ``spaced``: a border may stand between any two characters."""
        return self._decode(written, spaced)[1]

    def _decode(self, written: str, spaced: bool = False) -> tuple[float, str]:
        """The likeliest reading's log-probability, and the reading."""
        runs: list[tuple[str, int]] = []
        for c in written:
            if runs and runs[-1][0] == c:
                runs[-1] = (c, runs[-1][1] + 1)
            else:
                runs.append((c, 1))
        stars = runs.pop()[1] if runs and runs[-1][0] == "*" and runs[-1][1] <= STARS and not spaced else 0
        runs = [x for c, n in runs for x in ([(c, 1)] * n if c == "*" and n <= STARS else [(c, n)])]
        log_p, contexts, doubled = self.log_p, self.contexts, bool(_DOUBLED.search(written))
        # context -> (log-probability, reading as a linked list)
        states: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
        for i, (c, n) in enumerate(runs):
            following: dict[int, tuple[float, tuple]] = {}
            readings = self._readings(c, n, doubled)
            if spaced and i:
                readings = readings + [(f" {x}", cost + BORDER) for x, cost in readings if x.strip()]
            for context, (score, path) in states.items():
                for letters, cost in readings:
                    at, total = context, score + cost
                    for x in letters:
                        s = 0 if x == " " else ord(x) - 96 if "a" <= x <= "z" else 27
                        if s or at:  # borders in a row are one
                            total += log_p[at * SYMBOLS + s]
                            at = (at * SYMBOLS + s) % contexts if s else 0
                    if at not in following or total > following[at][0]:
                        following[at] = (total, (path, letters))
            states = following
        ending = self.endings[stars][0]
        total, best, at = max((score + float(ending[at]), path, at) for at, (score, path) in states.items())
        tail = []
        for n in range(stars, 0, -1):
            x = int(self.endings[n][1][at])
            tail.append("" if x == 27 else " " if x == 0 else chr(96 + x))
            at = at if x == 27 else (at * SYMBOLS + x) % self.contexts if x else 0
        out = ["".join(tail)]
        while best:
            best, letters = best
            out.append(letters)
        return total, "".join(reversed(out))

    def _without_letters(self, written: str, spaced: bool = False) -> str:
        """The reading of symbols and digits, or nothing where they rather stand for themselves."""
        if len(written) < 2 or not any(c in LEET for c in written):
            return ""
        total, found = self._decode(written, spaced)
        return found if total > ITSELF * len(written) else ""

    def token(self, token: str) -> str:
        """The restored words of a token without white space, joined by spaces."""
        core = _NOISE_RUN.sub("", token).lstrip(_LEFT).rstrip(_RIGHT)
        whole = token.lstrip(_LEFT).rstrip(_RIGHT)
        if core and whole != core and _LETTER.search(core) and _STAR_RUN.search(whole) and not (whole[0] == whole[-1] == "*"):
            total, found = self._decode(core)
            stars, filled = self._decode(whole)
            return filled if stars > total + BORDER else found
        if core.isalpha() and not _TWICE.search(core):
            return core
        if not _LETTER.search(core):
            return core if core.isalpha() else self._without_letters(core)
        return self.decode(core)

    def spaced(self, text: str) -> list[str]:
        """The restored words of the runs of single characters in a text in lower case."""
        return [w for m in _SPACED.finditer(text) for w in self._run("".join(m[0].split())).split()]

    def _run(self, written: str) -> str:
        return self.decode(written, True) if _LETTER.search(written) else self._without_letters(written, True)

    def restore(self, text: str) -> str:
        """The whole text, restored: each token's words, runs of single characters as words."""
        lower, out, at = text.lower(), [], 0
        for m in _SPACED.finditer(lower):
            out += [self.token(w) for w in lower[at:m.start()].split()]
            out.append(self._run("".join(m[0].split())) or m[0])
            at = m.end()
        return " ".join(w for w in [*out, *(self.token(w) for w in lower[at:].split())] if w)


class _Words(dict):
    """Token -> what the model needs of its restored words; of bounded size."""

    def __init__(self, restorer: Restorer, keep):
        super().__init__()
        self.restorer, self.keep = restorer, keep

    def __missing__(self, token: str):
        found = self.keep(self.restorer.token(token).split())
        if len(token) <= KEEP_CHARS:
            if len(self) >= KEEP:
                self.clear()
            self[token] = found
        return found

    def of(self, text: str) -> set:
        """The union over all tokens and runs of single characters of a text."""
        lower = text.lower()
        found = set().union(*set(map(self.__getitem__, lower.split())))
        return found.union(self.keep(self.restorer.spaced(lower)))


@dataclass
class Model:
    log_p: np.ndarray
    weights: dict[str, float]
    intercept: float


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def _training_rows(docs: DataFrame, labels: DataFrame, log_p: np.ndarray, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """(toxic, words): distinct restored words of a bounded sample of labelled texts, equal texts once."""
    usable = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic"))
    usable = usable.filter(F.col("toxic").isin(0, 1) & F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    share = most / max(1, usable.count())
    drawn = usable.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < F.lit(share * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(Restorer(log_p), lambda found: tuple(w for w in found if len(w) > 1))
        for b in slices(batches):
            found = pa.array([sorted(words.of(t)) for t in texts(b)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("toxic"), found], names=["key", "toxic", "words"])

    rows = narrow(docs, id_col, text_col, F.xxhash64(F.col(text_col)).alias("key"))
    rows = rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select("key", "toxic", "text")
    return cut(rows.mapInArrow(run, "key long, toxic int, words array<string>").dropDuplicates(["key", "toxic"]))


def word_features(word: str) -> list[str]:
    """The word, and its beginnings with a star: a stem tells what its endings share."""
    return [word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)]


def _telling_features(rows: DataFrame, n: int, positive: int, most: int) -> list[str]:
    """Features of more texts of label 1 than chance explains, the surest first.

    Of features that begin alike and occur in as many texts of either label, one is enough.
    """
    starts = [F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in STEMS]
    found = rows.select("key", "toxic", F.explode("words").alias("word"))
    found = found.select("key", "toxic", F.explode(F.array_compact(F.array("word", *starts))).alias("feature"))
    counts = (found.distinct().groupBy("feature").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= MIN_DOCS))
    a, b = F.col("a") + 0.5, F.col("n") - F.col("a") + 0.5
    z = (F.log(a / (positive + 1)) - F.log(b / (n - positive + 1))) / F.sqrt(1 / a + 1 / b)
    surest = counts.select("feature", "a", "n", z.alias("z")).filter(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "feature")
    chosen, seen = [], set()
    for r in surest.limit(8 * most).collect():
        alike = (r["feature"][:min(STEMS)], r["a"], r["n"])
        if alike not in seen:
            seen.add(alike)
            chosen.append(r["feature"])
    return chosen[:most]


def _fit(x: np.ndarray, y: np.ndarray, n: np.ndarray, l2: float = 0.3, steps: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression of weighted rows by Newton's method; the intercept is not held back."""
    x = np.c_[x, np.ones(len(x))]
    hold = np.full(x.shape[1], l2)
    hold[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(hold), x.T @ (n * (p - y)) + hold * w)
        w -= step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most: int = TRAIN_ROWS, features: int = FEATURES) -> Model:
    """Language model over all documents, weights from a bounded sample of labelled ones.

    Only the counts of the features come to the driver, a row per set of features and label.
    """
    log_p = language_model(gram_counts(docs, text_col))
    rows = _training_rows(docs, labels, log_p, id_col, text_col, label_col, most)
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < positive < n:
        return Model(log_p, {}, float(np.log((positive + 0.5) / (n - positive + 1.0))))
    chosen = _telling_features(rows, n, positive, features)
    place = {f: i for i, f in enumerate(chosen)}

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = [sorted(place[f] for w in words for f in word_features(w) if f in place) for words in b.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(held, pa.list_(pa.int32()))], names=["toxic", "held"])

    held = rows.select("toxic", "words").mapInArrow(hold, "toxic int, held array<int>")
    table = held.groupBy("held", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    table.sort(key=lambda r: (r["toxic"], r["held"]))
    x = np.zeros((len(table), len(chosen)))
    for i, r in enumerate(table):
        np.add.at(x[i], r["held"], 1.0)  # how many distinct words of the text have the feature
    weights, intercept = _fit(x, np.array([r["toxic"] for r in table], float), np.array([r["n"] for r in table], float))
    return Model(log_p, dict(zip(chosen, weights.tolist(), strict=True)), intercept)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the chance of label 1."""
    keep = docs.columns if keep is None else keep
    log_p, weights, intercept = model.log_p, model.weights, model.intercept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def weigh(found: list[str]) -> tuple[tuple[str, float], ...]:
            total = ((w, sum(weights.get(f, 0.0) for f in word_features(w))) for w in found if len(w) > 1)
            return tuple((w, x) for w, x in total if x)

        words = _Words(Restorer(log_p), weigh)
        for b in slices(batches):
            z = np.array([intercept + sum(x for _, x in sorted(words.of(t))) for t in texts(b, text_col)], float)
            found = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(found)], names=[*keep, name])

    return docs.mapInArrow(run, ", ".join(f"`{c}` {id_type(docs, c)}" for c in keep) + f", `{name}` double")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The input rows whose score is below one half, with all their columns."""
    found = score(docs, train(docs, labels, id_col, text_col, label_col), text_col, "_tx_score")
    return found.filter("_tx_score < 0.5").drop("_tx_score")


def restored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, restored): the whole texts after deobfuscation."""
    log_p = model.log_p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(log_p)
        for b in slices(batches):
            found = pa.array([restorer.restore(t) for t in texts(b)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), found], names=["doc_id", "restored"])

    return narrow(docs, id_col, text_col).mapInArrow(run, f"doc_id {id_type(docs, id_col)}, restored string")
