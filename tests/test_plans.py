"""Scale guards on physical plans: no cartesian products, no broadcast of unbounded sides."""

from tessera.operators import vocab as V
from tessera.plans import registry as REG
from tessera.sources import tables

from conftest import SF01


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_encode_and_decode_neither_explode_nor_shuffle(spark):
    c = tables.captions(spark, SF01)
    vocab = V.build_vocabulary(c)
    for df in (V.encode(c, vocab), V.decode(V.encode(c, vocab), vocab)):
        p = plan(df)
        assert "Exchange" not in p and "Generate" not in p and "Sort" not in p and "MapInArrow" in p


def test_vocabulary_looks_for_first_occurrences_of_tied_words_only(spark, monkeypatch):
    c = tables.captions(spark, SF01)
    p = plan(V.build_vocabulary(c))
    sorted_part = p.split("TakeOrderedAndProject")[1]
    assert "LeftSemi" in sorted_part  # the tokens that are aggregated with a sort are those of tied words


def test_large_vocabularies_are_joined_and_give_the_same(spark, monkeypatch):
    c = tables.captions(spark, SF01).limit(200)
    vocab = V.build_vocabulary(c, 300).checkpoint()
    small = {(r["key"], r["caption_no"]): r["tokens"] for r in V.encode(c, vocab).collect()}
    enc = V.encode(c, vocab)
    text = {(r["key"], r["caption_no"]): r["text"] for r in V.decode(enc, vocab).collect()}
    monkeypatch.setattr(V, "LOOKUP_ROWS", 10)
    large = V.encode(c, vocab)
    assert "BroadcastNestedLoopJoin" not in plan(large)
    assert {(r["key"], r["caption_no"]): r["tokens"] for r in large.collect()} == small
    assert {(r["key"], r["caption_no"]): r["text"] for r in V.decode(enc, vocab).collect()} == text


def test_bleu_reads_each_side_once_in_one_partitioning(spark):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for q, single in ((REG.q_corpus_bleu, 1), (REG.q_bleu_statistics, 1), (REG.q_sentence_bleu, 0), (REG.q_clipped_matches, 0)):
            p = plan(q(spark, SF01))
            assert "Join" not in p and "CartesianProduct" not in p
            # by key and gram, by key, and for the corpus by nothing
            assert p.count("Exchange hashpartitioning") == 2 and p.count("Exchange SinglePartition") == single
            assert p.count("FileScan") == 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_knn_is_cogrouped_not_cartesian(spark):
    from tessera.operators import similarity as SIM
    f = tables.features(spark, SF01)
    # the plan that computes the neighbours (the registered query reads its checkpoint)
    p = plan(SIM.nearest(f.filter("key % 5 = 0"), f.filter("key % 5 <> 0"), 5, materialize=False))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "FlatMapCoGroupsInPandas" in p


def test_word_counts_partial_aggregation_and_pruning(spark):
    df = V.word_counts(tables.documents(spark, SF01))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("HashAggregate") >= 2
    scan = df._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in scan or "struct<text:string" in scan


def test_vocabulary_top_n_is_bounded(spark):
    p = plan(REG.q_vocabulary(spark, SF01))
    assert "TakeOrderedAndProject" in p


# decode loops and streams run many jobs while being built; their joins are guarded elsewhere
_SLOW = {"generate_captions", "evaluate_generated", "corpus_greedy_decode", "score_sequences",
         "encode_stream", "features_stream", "image_vectors_stream"}


def test_registered_plans_have_no_pairs_and_no_unbounded_single_partition(spark):
    from conftest import SF001
    for name, q in REG.QUERIES.items():
        if name in _SLOW:
            continue
        lines = plan(q(spark, SF001)).split("\n")
        text = "\n".join(lines)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # only one partial result per partition may cross into a single task
                assert "partial_" in lines[i + 1] or "TakeOrderedAndProject" in lines[i + 1], (name, line)


def test_checkpoint_folder_is_read_from_the_session_not_replaced(spark):
    from tessera.session import ensure_checkpoint_dir
    before = spark.sparkContext.getCheckpointDir()
    assert before and ensure_checkpoint_dir(spark) == before
    assert spark.sparkContext.getCheckpointDir() == before
