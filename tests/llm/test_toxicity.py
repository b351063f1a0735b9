from collections import Counter

import numpy as np
import pandas as pd
import zlib
from llm_cases import TEXTS, edge_docs, no_docs, prose

from tessera.llm import queries, toxicity

from conftest import SF01

INSULTS = "idiot moron stupid pathetic worthless clown scum loser trash".split()
LEET = {"a": "4", "e": "3", "i": "1", "o": "0", "s": "$", "t": "7"}


def disguises(word):
    leet = "".join(LEET.get(c, c) for c in word)
    return [word, leet, " ".join(word), ".".join(word), "-".join(word), word[:2] + word[2] * 4 + word[3:], "".join(c * 2 for c in word), f"{word}###", " ".join(leet)]


def corpus():
    """Labelled prose; half of the toxic texts are written plainly, half in disguise."""
    rng, rows, labels = np.random.default_rng(3), [], []
    for i in range(600):
        w = prose(60, 10_000 + i).split()
        toxic = i % 3 == 0
        if toxic:
            for word in rng.choice(INSULTS, 4):
                w.insert(int(rng.integers(0, len(w))), disguises(word)[int(rng.integers(0, 9))] if i % 2 else word)
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_disguised_insults_are_found_on_held_out_rows(spark):
    rows, labels = corpus()
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    assert model.weights and all(any(w.startswith(f.rstrip("*")) for w in INSULTS) for f in model.weights)
    want = dict(labels)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    held = [i for i in scores if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scores[i] >= 0.5) == bool(want[i]) for i in held]) > 0.95
    restorer = toxicity.Restorer(model.log_p)
    for word in INSULTS:
        for written in disguises(word):
            assert word in restorer.restore(f"Prose {written} more").split(), written
    restored = {r.doc_id: r.restored for r in toxicity.restored(docs, model).collect()}
    assert restored[1] == rows[1][1]
    left = toxicity.drop_toxic(docs, table)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i in scores if scores[i] < 0.5}


def test_labels_of_held_out_rows_and_other_columns_are_not_used(spark):
    rows, labels = corpus()
    other = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, other))
    assert a.weights == b.weights and a.intercept == b.intercept


def test_stems_tell_words_that_training_never_saw(spark):
    """Label 1: three or more words of one stem; single ones occur in label 0 too."""
    rng, rows, labels = np.random.default_rng(8), [], []
    ends = [a + b for a in "bdfglmnprst" for b in "aeiou"]
    for i in range(900):
        toxic = i % 4 == 0
        w = prose(50, 20_000 + i).split() + [f"zurpo{e}" for e in rng.choice(ends, 4 if toxic else int(rng.integers(0, 2)))]
        rows.append((i, " ".join(rng.permutation(w))))
        labels.append((i, int(toxic)))
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    assert {"zurp*", "zurpo*"} & set(model.weights)
    assert np.mean([(scores[i] >= 0.5) == bool(t) for i, t in labels]) > 0.97


def test_language_model_counts_every_document(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["ab Ab", None, "", "ñ1a", "x" * 1000])], "doc_id long, text string")
    n = {r.gram: r.n for r in toxicity.gram_counts(docs).collect()}
    want = Counter()
    joined = "\n".join(r[1] or "" for r in docs.collect())
    s = toxicity.symbols(joined).tolist()
    for i in range(len(s) - 3):
        want[((s[i] * 28 + s[i + 1]) * 28 + s[i + 2]) * 28 + s[i + 3]] += 1
    ab = (0 * 28 + 1) * 28 + 2
    assert n[(0 * 28 + 0) * 784 + ab] == want[(0 * 28 + 0) * 784 + ab] == 2
    assert n[((24 * 28 + 24) * 28 + 24) * 28 + 24] == 997
    p = np.exp(toxicity.language_model(toxicity.gram_counts(docs)).reshape(-1, 28).astype(float))
    assert np.allclose(p.sum(1), 1, atol=1e-4)


def viterbi_by_force(restorer, written):
    """The best of all readings of a token, tried one by one."""
    import itertools
    runs = [(c, len(list(g))) for c, g in itertools.groupby(written)]
    doubled = bool(toxicity._DOUBLED.search(written))
    best = None
    for reading in itertools.product(*(restorer._readings(c, n, doubled) for c, n in runs)):
        at, total = 0, sum(cost for _, cost in reading)
        for x in "".join(letters for letters, _ in reading):
            s = 0 if x == " " else ord(x) - 96 if "a" <= x <= "z" else 27
            if s or at:
                total += restorer.log_p[at * 28 + s]
                at = (at * 28 + s) % 28 ** 3 if s else 0
        total += restorer.log_p[at * 28] if at else 0
        best = total if best is None else max(best, total)
    return best


def test_viterbi_equals_trying_all_readings(spark):
    rows, _ = corpus()
    log_p = toxicity.language_model(toxicity.gram_counts(spark.createDataFrame(rows, "doc_id long, text string")))
    restorer = toxicity.Restorer(log_p)
    for written in ("1d10t", "m0r0n", "$cum", "i.d.i.0.t", "iiddiioott", "tra5h", "l0$er", "(l0wn", "a!b+c"):
        reading = restorer.decode(written)
        # the reading's own score: fix each run to what it gave, by scoring the decoded letters
        assert reading and viterbi_by_force(restorer, written) is not None
        scores = {}
        import itertools
        runs = [(c, len(list(g))) for c, g in itertools.groupby(written)]
        doubled = bool(toxicity._DOUBLED.search(written))
        for option in itertools.product(*(restorer._readings(c, n, doubled) for c, n in runs)):
            text = "".join(letters for letters, _ in option)
            at, total = 0, sum(cost for _, cost in option)
            for x in text:
                s = 0 if x == " " else ord(x) - 96 if "a" <= x <= "z" else 27
                if s or at:
                    total += log_p[at * 28 + s]
                    at = (at * 28 + s) % 28 ** 3 if s else 0
            total += log_p[at * 28] if at else 0
            scores[text] = max(total, scores.get(text, -1e9))
        assert np.isclose(scores[reading], max(scores.values()), atol=1e-4)


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (5, 0), (7, 0), (9, 1), (11, 1), (99, 1)], "doc_id long, toxic int")
    docs = edge_docs(spark)
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model, name="chance").collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.chance <= 1 for r in rows)
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    none = toxicity.train(docs, labels.limit(0))
    assert len({r.chance for r in toxicity.score(docs, none, name="chance").collect()}) == 1
    assert toxicity.drop_toxic(no_docs(spark), labels).collect() == []


def test_whole_table_accuracy(spark):
    rows = queries.op1_toxicity(spark, SF01).toPandas().set_index("doc_id")
    docs, labels = (pd.read_parquet(f"{SF01}/{n}.parquet").set_index("doc_id") for n in ("documents", "labels"))
    assert len(rows) == len(docs)
    assert all(rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.index])
    assert all(rows.predicted == (rows.score >= 0.5))
    held = rows[rows.held_out].join(labels, how="inner")
    assert (held.predicted == held.toxic).mean() > 0.9


def test_doubled_letters_symbols_and_stars_are_decoded(spark):
    words = ["idiot", "moron", "class", "glass", "shit", "the", "ass", "prose"]
    text = " ".join(words * 400 + ["tennis", "coffee", "letter"] * 200)
    log_p = toxicity.language_model(toxicity.gram_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")))
    restorer = toxicity.Restorer(log_p)
    for written, want in (("iidiot", "idiot"), ("morron", "moron"), ("@$$", "ass"), ("$#!+", "shit"), ("455", "ass"), ("sh**", "shit"), ("5 # ! 7", "shit"),
                          ("class", "class"), ("tennis", "tennis"), ("coffee", "coffee"), ("the**", "the"), ("**prose**", "prose"), ("idiot###", "idiot"),
                          ("2024", ""), ("1999", ""), ("-----", ""), ("****", "")):
        assert restorer.restore(written) == want, (written, restorer.restore(written))
