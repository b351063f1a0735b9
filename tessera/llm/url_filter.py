"""URL filter: host and path rules first, then a logistic regression on hashed n-grams.

A rule (host, path) fits its host and all subdomains when the path starts with the rule's; the
longest wins. Where none fits, the verdict is the model's: character n-grams of host and path,
hashed into a fixed number of features and weighted by a logistic regression that is trained
from a small labelled URL table, in which hosts decide in some rows and paths in others. The table
is a parameter of at most a few thousand rows; its weights are a vector of fixed size, sent with the tasks.

Null urls and urls without ``://`` have an empty host and path; no rule fits them and the model
judges the empty string (allow). Rows that repeat are judged each. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import id_type

#: (verdict, rule): fixed values of the contract.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
FEATURES = 1 << 15
NGRAMS = (3, 4, 5)
#: The labelled table: site names to block, names to allow, and syllables of further names to allow.
BLOCKED = ("adult adults xxx porn sexcam casino casinos poker bets betting free-bet bingo slots jackpot win-cash spam spammy link-farm seo-farm content-farm "
           "pills cheap-meds pharma viagra diet-pills replica-watches fake-bags warez torrent crack-keys phishing malware ads adserver ad-track tracker tracking "
           "click-bait popups escort hot-dates cheap-loans payday-loans free-money get-rich lottery").split()
ALLOWED = ("news weather science library museum university school history garden kitchen recipes travel maps music cinema theatre books poetry sports football "
           "health hospital city council forum wiki docs developer research journal archive photos nature animals forest ocean mountain energy transport railway "
           "market bakery workshop orchestra radio letters").split()
SYLLABLES = "an ber den el for ing lan mor nor on ran shi th tion ver wel".split()
_PREFIXES = ("", "www.", "m.", "blog.")
_SUFFIXES = ("example.com", "example.org", "example.net")
#: Endings of hosts outside the stand-in domains.
_FURTHER_SUFFIXES = ("com", "org", "net", "de", "co.uk", "io", "info")
_PATHS = ("/en/1234", "/fr/77.html", "/de/5/", "/es/909", "")
#: Forms of paths whose words decide: a word of the label, and a neutral word.
_WORD_PATHS = ("/{0}/{1}.html", "/en/{0}", "/{1}/{0}-{1}/12", "/{0}-{1}.php", "/a/{1}/{0}/", "/{0}", "/{0}/", "/{1}/{0}.html", "/{0}", "/en/{0}/12")
_ENDINGS = ("", "-x", "-hub", "24", "-online", "-world")


def labelled_urls() -> list[tuple[str, str, int]]:
    """(host, path, label; 1: block), dealt in turn: names under endings, so that in these rows only names tell,
    then words in paths under neutral hosts, each host with either label, so that in these only paths tell. Short names to block have few n-grams and stand in more rows."""
    further = [a + b for i, a in enumerate(SYLLABLES) for b in SYLLABLES[i % 3::3]]
    rows = []
    for label, names, times in ((1, BLOCKED, 4), (0, ALLOWED, 4), (0, further, 3)):
        for k, name in enumerate(n for n in names for _ in range(times)):
            rows.append((f"{_PREFIXES[k % 4]}{name}{_ENDINGS[k % 6]}.{_SUFFIXES[k % 3]}", _PATHS[k % 5], label))
    for label, names, times in ((1, BLOCKED, 16), (1, [n for n in BLOCKED if len(n) < 6], 16), (0, ALLOWED, 8), (0, further, 7)):
        for k, name in enumerate(n for n in names for _ in range(times)):
            rows.append((f"{_PREFIXES[k % 4]}{name}{_ENDINGS[k % 6]}.{_FURTHER_SUFFIXES[k % 7]}", _PATHS[k % 5], label))
    neutral = [*ALLOWED, *further]
    for label, words in ((1, BLOCKED), (0, ALLOWED), (0, further)):
        for k, word in enumerate(w for w in words for _ in range(20 if label else 10)):
            host = f"{_PREFIXES[k % 4]}{neutral[k * 7 % len(neutral)]}.{(_SUFFIXES + _FURTHER_SUFFIXES)[k // 3 % 10]}"
            rows.append((host, _WORD_PATHS[k % 10].format(word, neutral[k * 5 % len(neutral)]), label))
    return rows


def features(host: str, path: str) -> np.ndarray:
    """Sorted distinct features: hashed n-grams of the host and of the path, told apart by a tag."""
    found = set()
    for tag, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in NGRAMS:
            found.update(zlib.crc32(f"{tag}{text[i:i + n]}".encode()) % FEATURES for i in range(len(text) - n + 1))
    return np.array(sorted(found), np.int64)


def train(labelled: list[tuple[str, str, int]], l2: float = 0.3, steps: int = 500) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-regularised logistic regression, by gradient descent."""
    held = [features(host, path) for host, path, _ in labelled]
    used, place = np.unique(np.concatenate(held), return_inverse=True)
    x = np.zeros((len(labelled), len(used)), np.float32)
    x[np.repeat(np.arange(len(held)), [len(f) for f in held]), place] = 1
    y = np.array([r[2] for r in labelled], np.float32)
    w, b = np.zeros(len(used), np.float32), 0.0
    rate = 0.5 / float(x.sum(1).max())
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(x @ w + b)))
        w -= rate * (x.T @ (p - y) + l2 * w) / len(y) * 16
        b -= rate * float((p - y).mean()) * 16
    weights = np.zeros(FEATURES)
    weights[used] = w
    return weights, float(b)


def block_chance(host: str, path: str, weights: np.ndarray, bias: float) -> float:
    return float(1 / (1 + np.exp(-(weights[features(host, path)].sum() + bias))))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url as given, the host with A-Z in lower case."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        rule_host, _, rule_path = text.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rule_path}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          labelled: list[tuple[str, str, int]] | None = None) -> DataFrame:
    """(page_id, host, path, rule, score, verdict): one row per input row; score: the model's chance of block."""
    weights, bias = train(labelled or labelled_urls())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [block_chance(host, path, weights, bias) for host, path in zip(b.column("host").to_pylist(), b.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], names=[*b.schema.names, "score"])

    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.mapInArrow(score, f"page_id {id_type(pages, id_col)}, host string, path string, score double")
    model = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), "score", F.coalesce(verdict, model).alias("verdict"))
