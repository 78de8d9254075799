"""Divergences against plain integers, with blocks small enough to make many cells."""

import random
import re
from collections import Counter, defaultdict

from legajo.llm import divergence

SCHEMA = "doc_id long, lang string, source string, text string, part string, p long"


def brute(rows, least, top):
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", folded)
        sources[lang].add(source)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        total = Counter({t: sum(counts[lang, s][t] for s in names) for t in kept})

        def shares(c):
            size = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // size for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        of, all_of = {s: shares(counts[lang, s]) for s in names}, shares(total)
        for s in names:
            pairs = [(o, sum(f(of[s][t], of[o][t]) for t in kept)) for o in names if o != s]
            words = [(t, f(of[s][t], all_of[t])) for t in kept if counts[lang, s][t] and of[s][t] > all_of[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items[:most], 1)}
    return out


def rows_of(df):
    rows = df.collect()
    got = {(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in rows}
    assert len(got) == len(rows)
    return got


def corpus():
    rng = random.Random(2)
    words = ["alfa", "BETA", "Ñandú", "ñandú", "é", "x", "zz", "d'or", "Straße", "漢字"] + [f"w{c}" for c in "abcdefghijklmnop"]
    rows = []
    for i in range(400):
        lang = rng.choice(["es", "es", "fr", None])
        source = rng.choice([None, "", "a", "b", "c", "d", "e", "ab", "é"])
        rows.append((lang, source, rng.choice([None, "", "1 2 3"]) if i % 40 == 0 else " ".join(rng.choices(words, k=rng.randint(1, 30)))))
    rows += [("xx", "lonely", "no term occurs often"), ("xx", "other", None), ("yy", "one", "solo")]
    return rows + rows[:25]


def test_cells_against_plain_sums(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, *r, "clash", 7) for i, r in enumerate(rows)], SCHEMA).repartition(5)
    want = brute(rows, 10, 4)
    for groups, terms in ((2, 3), (3, 1000), (64, 4096)):
        assert rows_of(divergence.audit(docs, 10, 4, groups, terms)) == want
    assert {("xx", "lonely", "pair", "other", 0, 1), ("xx", "other", "pair", "lonely", 0, 1)} <= want
    assert not any(r[0] == "yy" for r in want)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_tasks_that_pass_counts_on_early(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(i, *r, "clash", 7) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    monkeypatch.setattr(divergence, "MOST_COUNTED", 20)
    assert rows_of(divergence.audit(docs, 10, 4)) == brute(rows, 10, 4)


def test_shares_of_very_large_counts(spark):
    """Products beyond 64 bits never arise."""
    values = [(0, 2), (10**9, 10**9 + 2), (8 * 10**15, 9 * 10**15), (123456789012, 987654321098765), (0, 0)]
    df = spark.createDataFrame(values, "n long, size long")
    got = [r[0] for r in df.select(divergence.share(df["n"], df["size"])).collect()]
    assert got == [1 + 10**9 * (n + 2) // size if size else 0 for n, size in values]
