"""Measures against plain Python, cutoffs against the exact binomial test."""

import random
import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from legajo.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def texts():
    rng = random.Random(4)
    vocabulary = ["uno", "dos", "#", "é&", "<x>", "\U0001f600", "*", "tres"] + [f"p{i}" for i in range(40)]
    gaps = [" ", "  ", "\n", "\n\n", "\t", "\x0b", " ", "\x1c"]
    out = ["".join(w for _ in range(rng.randint(0, 120)) for w in (rng.choice(vocabulary), rng.choice(gaps))) for _ in range(150)]
    passage = " ".join(f"q{i}" for i in range(15))
    out += [f"{passage} {' '.join(f'r{i}' for i in range(n))} {passage}" for n in (0, 3, 30, 90)]
    return out + [None, "", " \n ", "a " * 7, "a " * 9, "la misma línea\n" * 30, "w" * 100_000, "z " * 20_000, out[0], out[0]]


def test_measures(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 99, "x") for i, t in rows], "doc_id long, text string, n_words int, stratum string").repartition(4)
    out = quality.measured(df)
    got = {r["doc_id"]: tuple(r[c] for c in (*quality.MEASURES, "base_failed")) for r in out.collect()}
    assert got == {i: by_hand(t) for i, t in rows} and "stratum" in out.columns
    assert quality.measured(df.filter("false")).count() == 0


def numbers(spark, rng, n=6_000):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        lang = rng.choice(["en", "en", "en", None, "xx"]) if i > 50 else "few"
        symbols = rng.choice([0, 0, 1, 2, 40 if lang != "xx" else 3]) if good and rng.random() < 0.02 else 0 if good else 60
        rows.append((i, lang, 100, 400, symbols, 0, 0, 4, 0, 10, False))
        labels.append((i, int(good)))
    schema = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in [*quality.MEASURES, "n_capitals", "n_marks", "n_lines"]) + ", base_failed boolean"
    return rows, labels, spark.createDataFrame(rows, schema), spark.createDataFrame(labels, "doc_id long, quality int")


def proven(marked, limit, delta=0.05):
    """{stratum: [chance of each cutoff]} and {stratum: cut}, from (stratum, largest share, good)."""
    chances, sizes, best = {}, {}, {}
    for lang in sorted({m[0] for m in marked}):
        mine = [m[1:] for m in marked if m[0] == lang]
        n = sizes[lang] = sum(g for _, g in mine)
        chances[lang] = []
        for c in range(1, quality.STEPS + 1):
            k = sum(g for v, g in mine if v >= c / quality.STEPS)
            chances[lang].append(sum(comb(n, j) * limit**j * (1 - limit) ** (n - j) for j in range(k + 1)) if k <= limit * n else 1)
    left, open_ = sum(sizes.values()), sorted(sizes, key=lambda s: (chances[s][0] / sizes[s], s))
    while open_ and chances[open_[0]][0] <= delta * sizes[open_[0]] / left:
        left -= sizes[open_.pop(0)]
    for lang, row in chances.items():
        mine = [m[1:] for m in marked if m[0] == lang]
        for c, chance in enumerate(row, 1):
            k, bad = (sum(g == want for v, g in mine if v >= c / quality.STEPS) for want in (1, 0))
            if chance <= delta * sizes[lang] / max(left, sizes[lang]) and bad - 10 * k > 0:
                best[lang] = max(best.get(lang, (0, 0)), (bad - 10 * k, c / quality.STEPS))
    return chances, {lang: cut for lang, (_, cut) in best.items()}


@pytest.mark.parametrize("limit", [0.005, 0.02, 0.08])
def test_cutoffs_keep_the_limit(spark, limit):
    rows, labels, df, marks = numbers(spark, random.Random(5))
    good = dict(labels)
    found = quality.cutoffs(df, marks, limit=limit).collect()
    got = {r["stratum"]: r["cut"] for r in found}
    marked = [(r[1] or "", max(r[4] / 100, 4 / 400), good[r[0]]) for r in rows]
    chances, want = proven(marked, limit)
    # Some 40 good labels prove 8 % at the whole error, which the other strata pass on.
    assert got == want and "en" in got and ("few" in got) == (limit == 0.08)
    for r in found:
        assert r["good"] == sum(g for s, _, g in marked if s == r["stratum"])
        assert r["rejected"] == sum(g for s, v, g in marked if s == r["stratum"] and v >= r["cut"]) <= limit * r["good"]
    judged = quality.judged(df, quality.cutoffs(df, marks, limit=limit)).collect()
    assert len(judged) == len(rows)
    for r in judged:
        cut = got.get(r["lang"] or "")
        assert r["kept"] == (cut is None or max(r["n_symbols"] / 100, 0.01) < cut)


def test_a_wholly_valid_stratum_passes_its_error_on(spark):
    """200 good labels prove 2 % at the whole error, not at a third of it; the others never reject a good one and pass theirs on."""
    marked = [(lang, 0.0 if good else 0.6, good) for lang, n in (("one", 170), ("two", 2_000), ("xx", 2_000)) for good in [1] * n + [0] * 30]
    marked[0] = ("one", 0.02, 1)
    row = "doc_id long, lang string, n_words long, n_symbols long, quality int"
    df = spark.createDataFrame([(i, s, 100, round(v * 100), g) for i, (s, v, g) in enumerate(marked)], row)
    zero = {c: F.lit(0).cast("long") for c in ("n_dup_lines", "n_repeat_words", "n_capitals", "n_marks")}
    df = df.withColumns(zero | {"word_chars": F.lit(400).cast("long"), "n_lines": F.lit(9).cast("long"), "base_failed": F.lit(False)})
    want = proven(marked, 0.02)[1]
    assert set(want) == {"one", "two", "xx"} and 0.98**170 > 0.05 * 170 / 4_170
    assert {r["stratum"]: r["cut"] for r in quality.cutoffs(df.drop("quality"), df.select("doc_id", "quality")).collect()} == want


def test_the_limit_holds_on_labels_that_chose_nothing(spark):
    rows, labels, df, marks = numbers(spark, random.Random(9), 8_000)
    good, half = dict(labels), F.crc32(F.col("doc_id").cast("string")) % 2
    cuts = quality.cutoffs(df, marks.filter(half == 0))
    assert cuts.count() > 0
    for lang in ("en", "", "xx"):
        other = quality.judged(df, cuts).filter(half == 1).filter(F.coalesce("lang", F.lit("")) == lang).collect()
        mine = [r["kept"] for r in other if good[r["doc_id"]]]
        assert mine.count(False) <= 0.02 * len(mine)


def test_a_cutoff_acts_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    df = quality.judged(*[(n, quality.cutoffs(n, labels)) for n in [quality.measured(docs).drop("text")]][0])
    rejected = df.filter("not kept and not base_failed").join(labels, "doc_id").groupBy("quality").count().collect()
    assert {r["quality"] for r in rejected} == {0} and rejected[0]["count"] >= 20


def test_without_labels_only_the_base_rules_hold(spark):
    _, _, df, marks = numbers(spark, random.Random(6), 100)
    cuts = quality.cutoffs(df, marks.filter("false"))
    assert cuts.count() == 0 and quality.judged(df, cuts).filter("kept").count() == 100
    twice = marks.union(marks).union(spark.createDataFrame([(None, 1), (3, None)], marks.schema))
    assert quality.cutoffs(df, twice).collect() == quality.cutoffs(df, marks).collect()


def test_all_labels_count(spark):
    """15,000 good labels prove a cutoff, among however many labels of another language."""
    ids = spark.range(500_000, numPartitions=8).withColumnRenamed("id", "doc_id")
    good = (F.col("doc_id") >= 100).cast("long")
    lang = F.when(F.col("doc_id") < 15_100, "few").otherwise("en")
    row = {"n_words": 100, "word_chars": 400, "n_dup_lines": 0, "n_repeat_words": 0, "n_capitals": 4, "n_marks": 0, "n_lines": 9}
    df = ids.select("doc_id", lang.alias("lang"), ((1 - good) * 60).alias("n_symbols"), *[F.lit(v).cast("long").alias(k) for k, v in row.items()], F.lit(False).alias("base_failed"))
    got = quality.cutoffs(df, ids.select("doc_id", good.alias("quality"))).collect()
    assert [tuple(r) for r in got] == [("few", 0.6, 15_000, 0)]
