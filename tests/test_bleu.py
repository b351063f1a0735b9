import math

import pytest

from tessera.operators import bleu as BL


def corpus(spark, hyps, refs):
    h = spark.createDataFrame([(k, t.split()) for k, t in hyps], "key bigint, tokens array<string>")
    r = spark.createDataFrame([(k, i, t.split()) for i, (k, t) in enumerate(refs)],
                              "key bigint, ref_no bigint, tokens array<string>")
    return h, r


def scores(spark, hyps, refs, weights=None):
    h, r = corpus(spark, hyps, refs)
    return {x["metric"]: x["score"] for x in BL.corpus_bleu(h, r, weights).collect()}


def test_identical_is_one(spark):
    s = scores(spark, [(1, "the cat sat on mats")], [(1, "the cat sat on mats")])
    assert s["BLEU-1"] == pytest.approx(1.0) and s["BLEU-4"] == pytest.approx(1.0)
    assert s["BLEU-3"] == pytest.approx(math.exp(0.99 * 0.0))


def test_disjoint_is_zero(spark):
    s = scores(spark, [(1, "a b c d")], [(1, "w x y z")])
    assert all(v == 0.0 for v in s.values())


def test_brevity_penalty(spark):
    s = scores(spark, [(1, "the cat")], [(1, "the cat sat on")], {"b1": (1, 0, 0, 0)})
    assert s["b1"] == pytest.approx(math.exp(1 - 4 / 2), abs=1e-6)


def test_clipped_counts(spark):
    h, r = corpus(spark, [(1, "the the the the the the the")],
                  [(1, "the cat is on the mat"), (1, "there is a cat on the mat")])
    st = BL.bleu_statistics(h, r).first()
    assert (st["m1"], st["d1"]) == (2, 7)


def test_closest_length_prefers_shorter(spark):
    h, r = corpus(spark, [(1, "a b c d e")], [(1, "a b c d"), (1, "a b c d e f")])
    assert BL.closest_reference_length(h, r).first()["ref_len"] == 4


def test_short_hypothesis_counts_one_in_denominator(spark):
    h, r = corpus(spark, [(1, "a b"), (2, "a b c d e")], [(1, "a b"), (2, "a b c d e")])
    st = BL.bleu_statistics(h, r).first()
    assert st["d4"] == 1 + 2 and st["m4"] == 2


def test_sentence_bleu_per_key(spark):
    h, r = corpus(spark, [(1, "a b c d"), (2, "x y z w")], [(1, "a b c d"), (2, "p q r s")])
    s = {(x["key"], x["metric"]): x["score"] for x in BL.sentence_bleu(h, r).collect()}
    assert s[(1, "BLEU-4")] == pytest.approx(1.0) and s[(2, "BLEU-1")] == 0.0


def test_weights_past_the_fourth_count(spark):
    hyps, refs = [(1, "a b c d e f")], [(1, "a b c d x f")]
    five = {"w5": (0.2,) * 5}
    assert scores(spark, hyps, refs, five)["w5"] == 0.0  # no 5-gram matches
    assert scores(spark, hyps, [(1, "a b c d e f")], five)["w5"] == pytest.approx(1.0)
    assert scores(spark, hyps, refs, {"w4": (0.25,) * 4})["w4"] > 0.0


def test_five_weights_equal_the_oracle(spark):
    import duckdb

    from tessera.plans import sqlparts as Q
    hyps = [(1, "a b c d e f g"), (2, "a b c d e"), (3, "no reference here at all")]
    refs = [(1, "a b c d e f x"), (2, "a b c d e f"), (2, "z a b c d e")]
    weights = {"w5": (0.2,) * 5, "w2": (0.5, 0.5)}
    con = duckdb.connect()
    con.execute("CREATE TABLE hyp0 (key BIGINT, t VARCHAR[]); CREATE TABLE refs (key BIGINT, ref_no BIGINT, t VARCHAR[])")
    for k, t in hyps:
        con.execute("INSERT INTO hyp0 VALUES (?, ?)", [k, t.split()])
    for i, (k, t) in enumerate(refs):
        con.execute("INSERT INTO refs VALUES (?, ?, ?)", [k, i, t.split()])
    want = dict(con.execute(f"WITH {Q.bleu_ctes(5)} {Q.bleu_scores_select('stats', weights=weights)}").fetchall())
    got = scores(spark, hyps, refs, weights)
    assert {k: round(v, 6) for k, v in got.items()} == want and want["w5"] > 0
    h, r = corpus(spark, hyps, refs)
    assert {x["key"] for x in BL.sentence_bleu(h, r).collect()} == {1, 2}
