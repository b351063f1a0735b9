import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import TEXTS, documents, edge_docs, no_docs
from tokenizers import Tokenizer

from tessera.llm import packing, queries
from tessera.llm.tokens import byte_bpe

from conftest import SF001

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts):
    want, got = Counter(), defaultdict(list)
    for i, t in texts:
        ids, at = ids_of(t), 0
        for n in packing.piece_lengths(len(ids)):
            want[i, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes()), len(ids)] += 1
            at += n
        assert at == len(ids)
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 1024 for r in rows)
    by_id = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_id == sorted(by_id, reverse=True)
    return got


def test_edge_rows(spark):
    check(packing.pack(edge_docs(spark)).collect(), TEXTS)
    assert packing.pack(no_docs(spark)).collect() == []


def test_whole_table_against_the_tokenizer(spark):
    check(queries.op5_packing(spark, SF001).collect(), [(r.doc_id, r.text) for r in documents(SF001).itertuples()])


def test_pieces_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "a few words to pack")], "doc_id long, text string")
    rows = sorted(packing.pack(docs, with_ids=True).collect(), key=lambda r: r.start)
    assert [i for r in rows for i in r.ids] == ids_of("a few words to pack")


@given(st.integers(0, 10_000))
def test_binary_lengths(n):
    lengths = packing.piece_lengths(n)
    assert sum(lengths) == n and all(x & (x - 1) == 0 and x <= 1024 for x in lengths)
    assert lengths == sorted(lengths, reverse=True)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0\u3000\u200bab's12é你🙂.<|endoftext|>"), max_size=40))
def test_chunked_ids_equal_the_tokenizer(text):
    got = np.frombuffer(byte_bpe().ids(text), "<u4").tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_chunked_ids_equal_the_tokenizer_on_any_text(text):
    got = np.frombuffer(byte_bpe().ids(text), "<u4").tolist()
    assert got == TOKENIZER.encode(text, add_special_tokens=False).ids
