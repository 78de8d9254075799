"""Ids and bytes against the tokenizer library on whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from legajo.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def texts(seed):
    rng = random.Random(seed)
    pieces = ["a", "B", "ñ", "\U0001f600", " ", "  ", "\n", "\t", "\x1c", "\u3000", "'s", "'ll", "12", "٣", "...", "word", "|", "<|endoftext|>"]
    out = ["".join(rng.choices(pieces, k=rng.randint(0, 400))) for _ in range(80)]
    out += [None, "", "x" * 4_000, " " * 3_000 + "y", "ab \n" * 700, "é" * 999 + "1" * 2_000, "it's " * 300]
    return out + out[:3]


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 1 << 10), (64, 16), (20, 20)])
def test_ids(spark, chunk, overlap):
    rows = list(enumerate(texts(chunk)))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string").repartition(3)
    encoded = bpe.encode(df, PATH, PATTERN, digest=True, chunk=chunk, overlap=overlap)
    assert encoded.columns == ["doc_id", "text", "key", "token_ids", "decoded_sha256"]
    got = {r["doc_id"]: r for r in encoded.collect()}
    whole = bpe.encoder(PATH, PATTERN)
    assert len(got) == len(rows)
    for i, text in rows:
        assert bytes(got[i]["token_ids"]) == np.array(whole.encode_ordinary(text or ""), "<u4").tobytes()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
        assert got[i]["text"] == text and got[i]["key"] == "x"


def test_no_rows(spark):
    assert bpe.encode(spark.createDataFrame([], "text string"), PATH, PATTERN).count() == 0
