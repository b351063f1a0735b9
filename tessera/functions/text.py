"""Pure Column expressions: tokenizers, markers, padding, shifting, n-grams.

Everything here is a built-in Spark expression (JVM side, whole-stage codegen); nothing
calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's behaviour -----------------------------
# Start and end marker words wrapped around every training caption.
MARK_START = "ssss"
MARK_END = "eeee"
# Characters the training tokenizer replaces by a blank before splitting on blanks
# (the default filter set of the Keras text tokenizer, plus tab and newline); the
# apostrophe is not in the set. Same string is used by the DuckDB oracle.
FILTER_PATTERN = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n]"""
# Plain evaluation tokens: word runs (letters, digits, underscore, one inner apostrophe part)
# or any single other non-blank character.
EVAL_PATTERN = r"[\p{L}\p{N}_]+(?:'[\p{L}\p{N}_]+)?|[^\s\p{L}\p{N}_]"
# Evaluation tokenizer: the published Penn Treebank word rules on lower-case text, as
# replacements in order; the text is padded by blanks before and split at blanks after. Both
# engines run these lists. Between them the periods inside the text that end no sentence are
# marked: those of known abbreviations, initials and ordinals.
EVAL_RULES_BEFORE = (
    (r'([\s(\[{<])"', r"\1 `` "),
    ('"', " '' "),
    (r"([:,])([^\d])", r" \1 \2"),
    (r"\.\.\.", " ... "),
    (r"([;@#$%&])", r" \1 "),
)
EVAL_RULES_AFTER = (
    (r"([^.\s])\.([\])}>']*\s)", r"\1 . \2"),
    (r"([^.])\.([\])}>']*)\s*$", r"\1 . \2 "),
    ("\u0001", "."),
    (r"([?!])", r" \1 "),
    (r"([^'])' ", r"\1 ' "),
    (r"([\]\[(){}<>])", r" \1 "),
    (r"--", " -- "),
    (r"([^' ])('s|'m|'d) ", r"\1 \2 "),
    (r"([^' ])('ll|'re|'ve|n't) ", r"\1 \2 "),
    (r" (can|d|gim|gon|got|lem|more|wan)(not|'ye|me|na|ta|'n) ", r" \1 \2 "),
    (r" (can|d|gim|gon|got|lem|more|wan)(not|'ye|me|na|ta|'n) ", r" \1 \2 "),  # neighbours share a blank
    (r" ('t)(is|was) ", r" \1 \2 "),
)
# A word with a period at its end, inside brackets or quotes; initials and ordinals.
PERIOD_WORD = r"^[(\[{<'`]*(.*[^.])\.[\])}>']*$"
INITIAL_OR_ORDINAL = r"^(\p{L}|\d+)$"
BLANKS = r"[ \t\n\r\f]+"
# Characters around a word that are no part of it.
OPENING = r"""["'(\[{<`]"""
TRAILING = r"""["')\]}>,;:!?]"""
# Padding id; also rendered as a blank word by token_to_word.
PAD_ID = 0
# -----------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def mark(c, start: str = MARK_START, end: str = MARK_END) -> Column:
    """Wrap a caption with the start and end marker words (``start + ' ' + text + ' ' + end``)."""
    return F.concat(F.lit(start + " "), _c(c), F.lit(" " + end))


def tokenize(c) -> Column:
    """Training tokenizer: lowercase, filter characters to blanks, split on blank, drop empties.

    A null text gives null; an empty or all-punctuation text gives an empty array.
    """
    cleaned = F.regexp_replace(F.lower(_c(c)), FILTER_PATTERN, " ")
    return F.filter(F.split(cleaned, " "), lambda x: x != F.lit(""))


def _replaced(text: Column, rules) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement.replace("\\1", "$1").replace("\\2", "$2"))
    return text


def eval_tokenize(c, abbreviations=()) -> Column:
    """Evaluation tokenizer: lower case, clitics and punctuation as tokens of their own, while
    numbers, ellipses and hyphenated words stay whole.

    A period at the end of a word is a token, for it ends a sentence, unless the word is one of
    ``abbreviations`` (lower case, without the period; ``operators.sentences`` learns them from a
    corpus), an initial or an ordinal with words behind it.
    """
    text = _replaced(F.concat(F.lit(" "), F.lower(_c(c)), F.lit(" ")), EVAL_RULES_BEFORE)

    def marked(words: Column) -> Column:
        def word(w, i):
            inner = F.regexp_extract(w, PERIOD_WORD, 1)
            keeps = inner.rlike(INITIAL_OR_ORDINAL)
            if abbreviations:
                keeps = keeps | inner.isin(*abbreviations)
            return F.when((i < F.size(words) - 1) & w.contains(".") & keeps, F.regexp_replace(w, r"\.([\])}>']*)$", "\u0001$1")).otherwise(w)
        return F.transform(words, word)

    words = let(F.split(F.regexp_replace(text, rf"{BLANKS}$", ""), BLANKS), marked)
    text = _replaced(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), EVAL_RULES_AFTER)
    return F.filter(F.split(text, r"\s+"), lambda x: x != F.lit(""))


def plain_tokenize(c) -> Column:
    """Plain evaluation tokens: lower-case word runs, other characters one by one."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(EVAL_PATTERN), F.lit(0))


def strip_markers(tokens, words=(MARK_START, MARK_END)) -> Column:
    """Drop marker words (string tokens) from a token array."""
    lits = [F.lit(w) for w in words]
    return F.filter(_c(tokens), lambda x: ~x.isin(*lits))


def strip_ids(tokens, ids) -> Column:
    """Drop the given ids (e.g. marker ids, padding) from an id array."""
    lits = [F.lit(int(i)) for i in ids]
    return F.filter(_c(tokens), lambda x: ~x.isin(*lits))


def pad_post(tokens, length) -> Column:
    """Zero-pad on the right and truncate on the right to ``length`` (int or Column)."""
    m = length if isinstance(length, Column) else F.lit(int(length))
    t = _c(tokens)
    fill = F.array_repeat(F.lit(PAD_ID), F.greatest(m - F.size(t), F.lit(0)))
    return F.slice(F.concat(t, fill), 1, m)


def shift_input(padded, length) -> Column:
    """Decoder input: all but the last position of a padded sequence of ``length``."""
    m = length if isinstance(length, Column) else F.lit(int(length))
    return F.slice(_c(padded), F.lit(1), m - 1)


def shift_target(padded, length) -> Column:
    """Decoder target: all but the first position (the input shifted by one step)."""
    m = length if isinstance(length, Column) else F.lit(int(length))
    return F.slice(_c(padded), F.lit(2), m - 1)


def ngrams(tokens, n, sep: str = " ") -> Column:
    """Array of n-grams (joined with ``sep``) of a token array; empty when shorter than n.

    ``n`` may be an int or a Column, so one pass can carry several orders as rows.
    """
    t = _c(tokens)
    nn = n if isinstance(n, Column) else F.lit(int(n))
    count = F.size(t) - nn + 1
    return F.when(
        count > 0,
        F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(t, i, nn), sep)),
    ).otherwise(F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row; inside lambdas Spark would compute it for each element."""
    return F.transform(F.array(value), body)[0]


def counted(items: Column) -> Column:
    """Array of (item, c: int): the distinct items of an array with how often they occur, in order.

    Counted in the row: the items are sorted, and equal ones are neighbours.
    """
    def runs(s):
        starts = F.filter(F.transform(s, lambda x, i: i), lambda i: (i == 0) | (F.get(s, i - 1) != F.get(s, i)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(s, i).alias("item"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).alias("c"))))

    return let(F.sort_array(items), runs)


def token_lengths(tokens) -> Column:
    """Length of a token array."""
    return F.size(_c(tokens))
