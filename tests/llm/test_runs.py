"""Word runs against brute force over all stretches, and odd rows."""

import hashlib
import random

import numpy as np
import pytest

from legajo.llm import runs


def longest_lyndon(s):
    """Up to the next smaller suffix."""
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and s[j:] > s[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(s, least, times):
    smallest = {}
    for q in range(1, len(s)):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i >= q:
                smallest.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((i, n, q) for (i, n), q in smallest.items() if n >= max(least, times * q))


def cases():
    rng = random.Random(5)
    for _ in range(1500):
        n, k = rng.randint(1, 50), rng.choice([1, 2, 3, 6])
        s = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randint(1, 6)
            s = [s[i if i < a else min(n - 1, a + (i - a) % p)] for i in range(n)]
        yield s
    a, b = [0], [1]
    for _ in range(9):
        a, b = a + b, a
        yield a


def test_lyndon_arrays_in_both_orders():
    for s in cases():
        assert runs.lyndon_array(s).tolist() == longest_lyndon(s)
        turned = [-w for w in s]
        assert runs.lyndon_array(turned).tolist() == longest_lyndon(turned)


@pytest.mark.parametrize("least,times", [(2, 2), (3, 3), (5, 4), (6, 4), (9, 5)])
def test_runs_with_and_without_leaving_words_out(least, times):
    for s in cases():
        want = brute_runs(s, least, times)
        assert [tuple(r) for r in runs.all_runs(np.array(s), least, times).tolist()] == want
        assert [tuple(r) for r in runs.word_runs([b"%d" % w for w in s], least, times).tolist()] == want


def test_extensions():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2, 300)
    a = rng.integers(0, 299, 200)
    b = a + rng.integers(1, 300, 200) % (300 - a) + (a == 299)
    a, b = a[b > a], b[b > a]
    common = runs.Extensions(ids)
    for i, j, ahead, behind in zip(a, b, common.forward(a, b), common.backward(a, b)):
        n = next((k for k in range(300) if j + k >= 300 or ids[i + k] != ids[j + k]))
        m = next((k for k in range(300) if i - k < 1 or ids[i - k - 1] != ids[j - k - 1]))
        assert (ahead, behind) == (n, m)


def test_rows(spark):
    text = "x " + "a b\t" * 5 + "a\nc c c c c c d"
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, " \n "), (5, "a b " * 6), (None, "z " * 30_000), (6, "w" * 200_000)]
    docs = spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, runs string")
    found = runs.periodic_runs(docs)
    got = {}
    for r in found.collect():
        got.setdefault(r["doc_id"], []).append((r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]))
    assert got[1] == [(19, [(1, 11, 2), (12, 6, 1)], "x a b c d")] * 2
    assert got[2] == got[3] == got[4] == [(0, [], "")]
    assert got[5] == [(6, [(0, 6, 1)], "a b")] and got[None] == [(30_000, [(0, 30_000, 1)], "z")]
    one = runs.digests(found.filter("doc_id = 1")).first()
    assert (one["n_runs"], one["start"], one["length"], one["period"], one["exponent_milli"]) == (2, 12, 6, 1, 6000)
    assert one["runs_sha256"] == hashlib.sha256(b"1,11,2\n12,6,1\n").hexdigest()
    assert one["collapsed_sha256"] == hashlib.sha256(b"x a b c d").hexdigest()
    none = runs.digests(found.filter("doc_id = 2")).first()
    assert none["start"] is none["exponent_milli"] is None and none["runs_sha256"] == none["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    # Of equal exponents the first run stands; 11 / 2 is less than 6.
    tie = runs.digests(runs.periodic_runs(spark.createDataFrame([(1, "a a a a a a b b b b b b")], "doc_id long, text string"))).first()
    assert (tie["start"], tie["length"], tie["n_runs"]) == (0, 6, 2)
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, times=1)
