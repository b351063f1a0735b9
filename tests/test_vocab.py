from pyspark.sql import functions as F

from tessera.operators import vocab as V


def caps(spark, rows):
    return spark.createDataFrame(rows, "key bigint, caption_no bigint, caption string")


def test_ids_by_count_then_first_seen(spark):
    df = caps(spark, [(1, 0, "b a"), (2, 0, "a b c")])
    v = {r["word"]: (r["id"], r["n"]) for r in V.build_vocabulary(df, 10, marked=False).collect()}
    # a and b both occur twice; b is seen first (key 1, position 0)
    assert v == {"b": (1, 2), "a": (2, 2), "c": (3, 1)}


def test_vocabulary_keeps_ids_below_num_words(spark):
    df = caps(spark, [(1, 0, "a a a b b c")])
    v = V.build_vocabulary(df, 3, marked=False).orderBy("id").collect()
    assert [(r["word"], r["id"]) for r in v] == [("a", 1), ("b", 2)]


def test_markers_get_top_ids(spark):
    df = caps(spark, [(1, 0, "x y"), (1, 1, "z w")])
    v = {r["word"]: r["id"] for r in V.build_vocabulary(df, 10).collect()}
    assert v["ssss"] == 1 and v["eeee"] == 2


def test_encode_keeps_order_and_empty_rows(spark):
    df = caps(spark, [(1, 0, "b a b"), (2, 0, "zzz qqq"), (3, 0, ""), (4, 0, None)])
    vocab = V.build_vocabulary(caps(spark, [(9, 0, "a b b")]), 10, marked=False)
    enc = {r["key"]: r["tokens"] for r in V.encode(df, vocab, marked=False).collect()}
    assert enc == {1: [1, 2, 1], 2: [], 3: [], 4: []}


def test_decode_skips_padding(spark):
    vocab = spark.createDataFrame([("a", 3, 1), ("b", 4, 1)], "word string, id int, n bigint")
    df = spark.createDataFrame([(1, 0, [3, 0, 4])], "key bigint, caption_no bigint, tokens array<int>")
    assert V.decode(df, vocab).first()["text"] == "a b"


def test_token_to_word_renders_padding_as_blank(spark):
    vocab = spark.createDataFrame([("a", 3, 1)], "word string, id int, n bigint")
    ids = spark.createDataFrame([(0,), (3,)], "id int")
    got = {r["id"]: r["word"] for r in V.token_to_word(ids, vocab).collect()}
    assert got == {0: " ", 3: "a"}


def test_round_trip_equals_text_without_unknown_words(spark):
    train = caps(spark, [(1, 0, "the cat sat"), (2, 0, "the dog")])
    vocab = V.build_vocabulary(train, 10)
    test = caps(spark, [(5, 0, "The cat, the BIRD!")])
    enc = V.encode(test, vocab, marked=False)
    assert V.decode(enc, vocab).first()["text"] == "the cat the"
