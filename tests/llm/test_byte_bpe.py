"""Ids equal the tiktoken library's and decode to the text's bytes."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_documents_and_edge_cases(spark, reference):
    random.seed(3)
    letters = "abzeéñ日本 \n\t12!?\U0001f600\x1c\x85\xa0 ²'s"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 300))) for _ in range(200)]
    texts += ["", None, " ", "<|endoftext|>", "e" * 50_000, "ab" * 20_000, "é" * 3000, "the the the"] + ["same text"] * 3
    rows = [(i, t, 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded int")  # a clashing name
    out = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH, PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    for row in out.collect():
        text = texts[row["doc_id"]] or ""
        assert row["ids"] == reference.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()


def test_whole_table(spark, reference):
    from tidemark.llm.queries import op6_byte_bpe

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op6_byte_bpe(spark, sf).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = reference.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_lower_ranks_that_merges_open_are_found():
    """A vocabulary where a merge makes a pair of a lower rank: one by one is the rule."""
    ranks = {bytes([i]): i + 10 for i in range(256)}
    ranks |= {b"ab": 300, b"abc": 1, b"bc": 299, b"cab": 2, b"abab": 0}
    codec = byte_bpe.Codec(ranks, PATTERN)
    reference = tiktoken.Encoding("small", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    random.seed(5)
    words = ["".join(random.choice("abc") for _ in range(random.randint(1, 14))) for _ in range(500)]
    import numpy as np

    for word, packed in zip(words, codec.encode(words)):
        assert np.frombuffer(packed, "<i4").tolist() == reference.encode_ordinary(word)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH, PATTERN).collect() == []
