import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import TEXTS, documents, edge_docs, no_docs, prose

from tessera.llm import queries, sp_dropout

from conftest import SF001

PLAIN = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_without_dropout_ids_are_the_plain_encoders():
    coder = sp_dropout.MergeDropout(dropout=0.0)
    for text in [*documents(SF001).text[:40], "a  b", " lead", "trail ", "\t\nx", "你好 🙂  zz", "   "]:
        assert ids(coder.encode(text)) == PLAIN.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=50), st.integers(-2 ** 63, 2 ** 63 - 1), st.sampled_from([0.0, 0.1, 0.5, 1.0]))
def test_every_text_decodes_to_itself(text, key, dropout):
    coder = sp_dropout.MergeDropout(dropout=dropout)
    assert coder.decode(coder.encode(text, key)) == text


def test_segmentations_vary_with_document_and_seed_and_repeat_with_both():
    text = prose(400, 5)
    a, b, c = (sp_dropout.MergeDropout(seed=s) for s in (1, 1, 2))
    assert a.encode(text, 1) == b.encode(text, 1)
    assert len({a.encode(text, k) for k in range(20)}) > 1 and a.encode(text, 1) != c.encode(text, 1)
    assert len(a.encode(text, 1)) > len(sp_dropout.MergeDropout(dropout=0.0).encode(text))
    assert ids(sp_dropout.MergeDropout(dropout=1.0).encode("abc")) == [PLAIN.piece_to_id(x) for x in ("▁", "a", "b", "c")]


def test_skipped_merges_come_at_the_given_rate():
    drawn = [sp_dropout._draw(k, i, i + 1, i + 2) < 0.1 * 2 ** 64 for k in range(400) for i in range(50)]
    assert np.mean(drawn) == pytest.approx(0.1, abs=0.01)


def test_edge_rows_round_trip_through_both_operators(spark):
    encoded = sp_dropout.encode(edge_docs(spark))
    got = sorted(((r.doc_id is None, r.doc_id), r.text) for r in sp_dropout.decode(encoded).collect() if r.doc_id is not None)
    assert got == sorted(((False, i), t or "") for i, t in TEXTS if i is not None)
    assert sp_dropout.encode(no_docs(spark)).collect() == [] and sp_dropout.round_trips(no_docs(spark)).collect() == []
    assert all(r.lossless for r in sp_dropout.round_trips(edge_docs(spark)).collect())


def test_whole_table(spark):
    rows = {r.doc_id: r for r in queries.op8_sp_dropout(spark, SF001).collect()}
    docs = documents(SF001)
    assert len(rows) == len(docs) and all(r.lossless for r in rows.values())
    by_id = {r.doc_id: r.ids for r in sp_dropout.encode(spark.read.parquet(f"{SF001}/documents.parquet")).collect()}
    for r in docs.itertuples():
        found = np.array(by_id[r.doc_id], "<u4").tobytes()
        assert rows[r.doc_id].n_ids == len(found) // 4 and rows[r.doc_id].ids_crc32 == zlib.crc32(found)
        assert rows[r.doc_id].n_bytes == len(r.text.encode())


def test_each_occurrence_has_the_distribution_of_its_own_draws():
    """' of' against draws one by one: many occurrences, with the shares that independent skips give."""
    from collections import Counter

    coder, rng, n = sp_dropout.MergeDropout(), np.random.default_rng(1), 20_000
    for word in (" of", " water"):
        got = Counter()
        for key in range(20):
            data, at = ids(coder.encode(" ".join([word[1:]] * 1000), key)), 0
            while at < len(data):
                end = at + 1
                while end < len(data) and not coder.vocab.spelled[data[end]].startswith(b" "):
                    end += 1
                got[tuple(data[at:end])] += 1
                at = end
        want = Counter()
        for _ in range(n):
            draws = rng.random(64) < sp_dropout.DROPOUT
            want[tuple(sp_dropout.segment(word, coder.vocab, iter(np.flatnonzero(draws).tolist()))[0])] += 1
        assert sum(got.values()) == n and len(got) > 2
        for k in set(got) | set(want):
            assert abs(got[k] - want[k]) < 6 * (got[k] + want[k] + 1) ** 0.5, (word, k, got[k], want[k])


def test_long_chunks_skip_as_short_ones_do():
    coder, text = sp_dropout.MergeDropout(), "ab" * 40
    skips = coder._skips(7, 0, 3)
    first = [next(skips) for _ in range(50)]
    assert first[0] == 3 and first == sorted(set(first))
    assert coder.decode(coder.encode(text, 3)) == text and len({coder.encode(text, k) for k in range(20)}) > 10


def test_a_batch_gives_what_agendas_one_by_one_give(monkeypatch):
    """Tables of agendas against ``segment`` with the draws of each occurrence; no short chunk is segmented by itself."""
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(rng.choice(list("abetheing\u2581\u4f60\x00\n\U0001f642"), rng.integers(0, 12))) for _ in range(rng.integers(0, 60))) for _ in range(150)]
    texts += ["", " ", "  x  ", "x" * 47, "a\x00", prose(300, 2)]
    keys = [int(k) for k in rng.integers(-2 ** 63, 2 ** 63 - 1, len(texts))]
    for dropout in (0.005, 0.1, 0.6, 1.0):
        coder, want = sp_dropout.MergeDropout(dropout=dropout, seed=4), []
        for text, key in zip(texts, keys, strict=True):
            mixed = sp_dropout.xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 4)
            chunks = sp_dropout._chunks(text)
            first = coder._passed(sp_dropout._first_draws(np.full(len(chunks), mixed, np.uint64), np.arange(len(chunks)))).tolist()
            want.append(b"".join(sp_dropout.pack(sp_dropout.segment(c, coder.vocab, coder._skips(mixed, i, first[i]))[0]) for i, c in enumerate(chunks)))
        with monkeypatch.context() as m:
            m.setattr(sp_dropout, "segment", None)
            assert coder.encode_all(texts, keys) == want
            assert [coder.encode(t, k) for t, k in zip(texts, keys, strict=True)] == want


def test_draws_of_arrays_are_the_draws_one_by_one():
    key, place, nth = np.array([0, 5, 2 ** 64 - 1], np.uint64), np.array([0, 3, 2 ** 32 - 1]), np.array([1, 1, 7])
    assert sp_dropout._draws(key, place, nth).tolist() == [sp_dropout._draw(*x) for x in zip(key.tolist(), place.tolist(), nth.tolist())]
