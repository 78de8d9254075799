"""The network against plain loops, held-out scores, and odd rows."""

import numpy as np
from pyspark.sql import functions as F

from legajo.llm import attention
from legajo.llm.attention import FEATURES, Network

SF = "/root/testdata/sf0.1"


def column(x, name):
    return x[:, FEATURES.index(name)]


def test_features_of_passages():
    text = "The same  WORD, the same word!\nx# 1a é (b) " + "the same " * 61
    x, starts = attention.bags([text, None, " \n", "Ab"])
    words = text.split()
    assert starts.tolist() == [0, 3, 4, 5] and len(x) == 6
    assert np.allclose(np.expm1(column(x, "words")), [64, 64, len(words) - 128, 0, 0, 1])
    assert not x[3].any() and not x[4].any()
    first, body = words[:64], " ".join(words[:64]).encode()
    assert np.isclose(np.expm1(column(x, "word_bytes")[0]), np.mean([len(w.encode()) for w in first]))
    assert np.isclose(column(x, "distinct")[0], len(set(first)) / 64) and np.isclose(column(x, "mark_ends")[0], 1 / 64)
    assert np.isclose(column(x, "capital_words")[0], 0) and np.isclose(column(x, "symbol_ends")[0], 1 / 64)
    assert np.isclose(column(x, "lead_capitals")[0], 2 / 64) and np.isclose(column(x, "digit_words")[0], 1 / 64)
    pairs = list(zip(words, words[1:]))
    assert np.isclose(column(x, "seen_pairs")[2], np.mean([pairs[i - 1] in pairs[: i - 1] for i in range(128, len(words))]))
    assert np.allclose(x[:3, : len(attention.KINDS)].sum(axis=1), 1) and np.isclose(column(x, "symbol_rate")[0], 1 / (len(body) + 2))
    # Whatever stands around a text, its features are the same.
    for texts in (["ends with the", text], ["zz " * 500, "  ", text, "\n\n same"], [text, None]):
        other, at = attention.bags(texts)
        own = texts.index(text)
        assert np.array_equal(other[at[own] : [*at, len(other)][own + 1]], x[:3])


def test_long_texts_are_read_whole(monkeypatch):
    monkeypatch.setattr(attention, "PIECE", 1000)
    text = " ".join(f"w{i}" for i in range(3000))
    assert b"".join(attention.pieces(text.encode())) == text.encode()
    assert b"".join(attention.pieces(b"x" * 2500)) == b"x" * 2500
    x, starts = attention.bags(["a b", text, "c"])
    assert np.isclose(np.expm1(column(x[starts[1] : starts[2]], "words")).sum(), 3000, rtol=1e-5)


def test_gradients_and_forward():
    rng = np.random.default_rng(4)
    x, starts, y = rng.normal(size=(23, len(FEATURES))), np.array([0, 1, 9, 15]), np.array([1.0, 0, 0, 1])
    net = Network.new(x, seed=3)
    f, w = net.forward(x, starts), net.weights
    for bag, (a, b) in enumerate(zip(starts, [*starts[1:], 23])):
        h = [np.tanh(((r - net.mean) / net.scale).clip(-8, 8) @ w["code"] + w["code0"]) for r in x[a:b]]
        e = [np.exp((np.tanh(v @ w["what"]) / (1 + np.exp(-(v @ w["gate"])))) @ w["weigh"]) for v in h]
        z = sum(u * v for u, v in zip(e, h)) / sum(e)
        assert np.isclose(f["logit"][bag], z @ w["score"] + w["score0"][0])
    loss = lambda: np.mean(np.log1p(np.exp(net.forward(x, starts)["logit"])) - y * net.forward(x, starts)["logit"])
    for name, g in net.gradients(x, starts, y).items():
        for at in np.ndindex(w[name].shape):
            if sum(at) % 5 == 0:
                w[name][at] += 1e-5
                up = loss()
                w[name][at] -= 2e-5
                assert np.isclose((up - loss()) / 2e-5, g[at], atol=1e-7)
                w[name][at] += 1e-5


def test_attention_finds_the_bad_passage():
    rng = np.random.default_rng(8)
    bags = [["plain words of text " * 16] * rng.integers(2, 6) for _ in range(300)]
    y = np.ones(300)
    for i in range(0, 300, 3):
        bags[i].insert(rng.integers(0, len(bags[i]) + 1), "wo$$$ rds### of%% te&& " * 16)
        y[i] = 0
    x, starts = attention.bags(["".join(b) for b in bags])
    net = attention.train(x, starts, y, seed=1)
    assert ((net.scores(x, starts) > 0.5) == (y == 1)).mean() > 0.99
    weight = net.forward(x, starts)["attention"]
    bad = column(x, "symbol_ends") > 0.5
    size = np.repeat(np.diff([*starts, len(x)]), np.diff([*starts, len(x)]))
    assert (weight[bad] * size[bad]).mean() > 1.5 * (weight[~bad] * size[~bad]).mean()


def test_held_out_accuracy_and_labels_stay_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = attention.fit(docs, labels)
    marked = docs.join(labels.select("doc_id", "quality"), "doc_id")
    rows = attention.scored(marked, model).join(labels, "doc_id").filter("held_out").collect()
    good, bad = [r["score"] for r in rows if r["quality"]], [r["score"] for r in rows if not r["quality"]]
    assert np.mean(np.array(good) >= 0.5) > 0.98 and np.mean(np.array(bad) < 0.5) > 0.95
    # Held-out labels, turned round, change no score.
    turned = labels.withColumn("quality", F.when(attention.in_training(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    some = docs.filter("doc_id < 300")
    assert sorted(attention.scored(some, attention.fit(docs, turned)).collect()) == sorted(attention.scored(some, model).collect())
    odd = [(None, "plain"), (5, None), (5, None), (6, ""), (7, "w" * 100_000), (8, "$# %%%"), (9, "x " * 300_000)]
    got = attention.scored(spark.createDataFrame([(*r, "z") for r in odd], "doc_id long, text string, score string"), model).collect()
    assert len(got) == len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert {r["n_passages"] for r in got if r["doc_id"] == 5} == {1} and attention.scored(docs.limit(0), model).count() == 0


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(i, f"texto {i}") for i in range(30)], "doc_id long, text string")
    for labels, want in (([], {0.0}), ([(i, 1) for i in range(30)], {1.0}), ([(1, None), (None, 1)], {0.0})):
        df = spark.createDataFrame(labels, "doc_id long, quality int")
        assert {r["score"] for r in attention.scored(docs, attention.fit(docs, df)).collect()} == want
