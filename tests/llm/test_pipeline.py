"""Stages of the pipeline, each against plain Python on its own input."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline as P
from legajo.llm import bpe
from test_minhash import brute
from test_quality import by_hand

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    odd = [(None, f"null {' '.join(f'w{i}' for i in range(50))}", None, None, None), (-1, None, "en", "src0", 0), (-2, "", "en", "src0", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.filter("doc_id = 3"))
    for name, stage in P.STAGES:
        place = str(tmp_path_factory.mktemp("stage") / "rows")
        docs.write.parquet(place)
        docs = spark.read.parquet(place)
        out.append((docs.collect(), docs.columns))
        docs = stage(spark, docs, SF)
    return [*out, (docs.collect(), docs.columns)]


def test_columns_stay(stages):
    assert all(columns == stages[0][1] for _, columns in stages[:-1])


def test_quality_rules_take_what_the_base_rules_reject(stages):
    before, after = stages[0][0], stages[1][0]
    # 87 labels prove no cutoff, so the base rules alone decide.
    assert sorted(map(repr, after)) == sorted(repr(r) for r in before if not by_hand(r["text"])[-1])


def test_one_document_of_each_group_stays(stages):
    before, after = stages[1][0], stages[2][0]
    first = brute([(r["doc_id"], r["text"]) for r in before], 80)
    want = {doc for doc, component in first.items() if doc == component}
    kept = [r["doc_id"] for r in after if r["doc_id"] is not None]
    assert sorted(kept) == sorted(want) and sum(r["doc_id"] is None for r in after) == sum(r["doc_id"] is None for r in before)


def test_secrets_go(stages):
    before, after = ({r["doc_id"]: r for r in stages[k][0]} for k in (2, 3))
    assert set(before) == set(after)
    key = re.compile(r'(token = ")[0-9a-fA-F]{40}"', re.I)
    for doc, row in before.items():
        want = re.sub(key, r'\1[secret]"', row["text"])
        assert after[doc]["text"] == want
        assert after[doc]["n_chars"] == (len(want) if want != row["text"] else row["n_chars"])


def test_the_mix_keeps_every_row(stages):
    assert sorted(map(repr, stages[3][0])) == sorted(map(repr, stages[4][0]))
    assert [r["doc_id"] for r in stages[3][0]] != [r["doc_id"] for r in stages[4][0]]


def test_ids_are_the_tokenizers(stages):
    enc = bpe.encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = {r["doc_id"]: r["text"] for r in stages[4][0]}
    assert sorted(map(repr, texts)) == sorted(repr(r["doc_id"]) for r in stages[5][0])
    for r in stages[5][0]:
        ids = np.array(enc.encode_ordinary(texts[r["doc_id"]]), "<u4").tobytes()
        assert bytes(r["token_ids"]) == ids and r["ids_sha256"] == hashlib.sha256(ids).hexdigest() and r["n_tokens"] == len(ids) // 4
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    # The place in the mix is carried along.
    order = [r["doc_id"] for r in sorted(stages[5][0], key=lambda r: (r["mix_file"], r["mix_row"]))]
    assert order == [r["doc_id"] for r in stages[4][0]]
