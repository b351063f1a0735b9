import numpy as np
import public_tokenizers
from llm_cases import TEXTS, documents, edge_docs, no_docs
from tokenizers import Tokenizer

from tessera.llm import queries, token_counts

from conftest import SF001

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, texts):
    n = np.array([len(TOKENIZER.encode(t or "", add_special_tokens=False).ids) for t in texts])
    want = sorted((int(x), int((n == x).sum()), int(n[n == x].sum()), int((n >= x).sum()), int(n[n >= x].sum()), int((n <= x).sum()), int(np.minimum(n, x).sum()))
                  for x in set(n.tolist()))
    assert sorted(tuple(r) for r in rows) == want
    return n


def test_edge_rows(spark):
    hist = token_counts.histogram(token_counts.length_counts(edge_docs(spark)))
    check(hist.collect(), [t for _, t in TEXTS])


def test_whole_table_with_totals_and_quantiles(spark):
    texts = documents(SF001).text.tolist()
    n = check(queries.op3_token_counts(spark, SF001).collect(), texts)
    hist = token_counts.histogram(token_counts.length_counts(spark.read.parquet(f"{SF001}/documents.parquet")))
    for limit in (0, 1, 128, 1000, 10 ** 6):
        assert tuple(token_counts.totals(hist, limit).first()) == (len(n), n.sum(), np.minimum(n, limit).sum(), (n > limit).sum())
    for q in (0.01, 0.25, 0.5, 0.9, 1.0):
        want = np.sort(n)[max(0, int(np.ceil(q * len(n) - 1e-9)) - 1)]
        assert token_counts.quantile(hist, q).first()[0] == want


def test_empty_table(spark):
    hist = token_counts.histogram(token_counts.length_counts(no_docs(spark)))
    assert hist.collect() == []
    assert tuple(token_counts.totals(hist, 10).first()) == (0, 0, 0, 0)
    assert token_counts.quantile(hist, 0.5).first()[0] is None
