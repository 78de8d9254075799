"""Near-duplicates against all pairs in plain Python."""

import random

import numpy as np
import pytest

from legajo.llm import minhash
from legajo.llm.graph import components


def shingle_set(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, percent):
    sets = {}
    for doc, text in rows:
        if doc is not None:
            sets.setdefault(doc, []).append(shingle_set(text))
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            linked = any(
                a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j]
            )
            if i < j and linked:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {doc: find(doc) for doc in ids}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijk", k=5))
    passage = [word() for _ in range(60)]
    rows, doc = [], 0
    for group in range(6):
        base = [word() for _ in range(rng.randint(60, 200))]
        for _ in range(rng.randint(2, 40)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
            rows.append((doc, " ".join(text)))
            doc += 1
    for _ in range(60):
        rows.append((doc, " ".join(passage + [word() for _ in range(rng.randint(3, 60))])))
        doc += 1
    rows += [(doc + i, rows[0][1].upper()) for i in range(40)]
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "uno dos"), (904, "Uno  DOS"), (905, "ÉÁ x"), (906, "éá x"), (None, rows[0][1])]
    rows += [(903, "uno dos"), (907, "z " * 30_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent, block", [(85, 512), (80, 8)])
def test_components(spark, percent, block):
    rows = corpus(percent)
    # A column of the operator's own name must not get in the way.
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(5)
    got = minhash.near_duplicates(df, percent=percent, block=block).collect()
    assert len(got) == len(rows)
    want, sizes = brute(rows, percent), {doc: len(shingle_set(t)) for doc, t in rows}
    for r in got:
        assert r["n_shingles"] == sizes[r["doc_id"]]
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).count() == 0


def test_a_chain_of_links_is_one_component(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5), (7, None)]
    rng.shuffle(links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_pruning_keeps_what_is_similar():
    rng = np.random.default_rng(3)
    hashes = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64)
    same, kept = hashes(900), 0
    for _ in range(200):
        a, b = (minhash.signature(np.r_[same, hashes(79)]) for _ in "ab")
        kept += len(minhash.survivors(a[None], b[None], 85, 1e-7))
    assert kept == 200
    far = [len(minhash.survivors(minhash.signature(hashes(500))[None], minhash.signature(hashes(500))[None], 85, 1e-7)) for _ in range(50)]
    assert sum(far) == 0
