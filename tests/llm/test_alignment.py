"""Alignment of two tokenizers' tokens against a token-by-token version."""

import os

import brute
import public_tokenizers
import pytest
from stationflow.llm.alignment import align_tokens

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", " a", "a ", "a  b", "a \n b", "x▁y", "<|endoftext|> <s>hi</s> <0x41>", "a\x00b", "  x", "日本語 é é ﬁ", "aaaa" * 5000, "\n\n\n" * 40 + "z", "🙂" * 30, "a\tb\r\nc", "=" * 3000, "it's 12,345.67 don't"]


@pytest.fixture(scope="module")
def plain():
    import sentencepiece
    from tokenizers import Tokenizer

    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    return lambda rows: sorted(map(repr, brute.alignment(rows, Tokenizer.from_file(A), pieces)))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_odd_texts(spark, docs, data, plain, block):
    kept = [(d, t) for d, t, *_ in data]
    odd = [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (7, "a b"), (7, "a b")]
    own = spark.createDataFrame(odd, "doc_id long, text string").repartition(3).unionByName(docs.select("doc_id", "text")).selectExpr("*", "1 AS pair", "'x' AS block", "2 AS n_a")
    assert rows(align_tokens(own, A, B, block_bytes=block)) == plain(odd + kept)


def test_no_documents(empty):
    assert align_tokens(empty, A, B).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_op12(spark, plain):
    import __spark_entry__

    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows(__spark_entry__.queries()["op12_alignment"](spark, SF)) == plain(texts)
