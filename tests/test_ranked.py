"""Ranked summaries against a loop over all sentences."""

import random
import re
import time
from collections import Counter
from math import floor, log

from pyspark.sql import functions as F

from legajo.functions import extract as X
from legajo.functions import text as T
from legajo.operators import ranked
from legajo.operators.ranked import summarize_ranked
from legajo.plans.queries import REGISTRY


def by_hand(texts, n):
    cuts = [[s for s in re.split(r"(?<=[.!?])\s+|\s*\n\s*", (t or "").strip())] for t in texts]
    words = [[set(re.findall(r"\w+", s.lower())) for s in cut] for cut in cuts]
    rows = Counter(w for doc in words for w in set().union(*doc))
    weight = {w: floor(1000 * log(len(texts) / k)) for w, k in rows.items()}
    out = []
    for cut, doc in zip(cuts, words):
        taken, picked = set(), []
        for _ in range(n):
            left = [(sum(weight[w] for w in ws - taken) * 1000 // len(ws), -i) for i, ws in enumerate(doc) if ws and i not in picked]
            if left:
                picked.append(-max(left)[1])
                taken |= doc[picked[-1]]
        out.append(" ".join(cut[i] for i in sorted(picked)))
    return out


def test_against_a_loop(spark):
    rng = random.Random(11)
    word = lambda: f"p{min(rng.randint(0, 60), rng.randint(0, 60))}"
    sentence = lambda: " ".join(word() for _ in range(rng.randint(1, 9))) + rng.choice(".!?")
    texts = [" ".join(sentence() for _ in range(rng.randint(1, 7))) for _ in range(80)]
    texts += [texts[0]] * 30 + [None, "", " \n ", "...", "a. a. a.", "una sola", "x y. !!! z"]
    texts.append(" ".join(sentence() for _ in range(3_000)))
    # Ids repeat and may be null.
    rows = [(None if i % 40 == 7 else i // 2, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, summary string").repartition(5)
    for n in (1, 2, 4):
        got = Counter(tuple(r) for r in summarize_ranked(df, sentences=n, plain=True).collect())
        assert got == Counter((d, s) for (d, _, _), s in zip(rows, by_hand(texts, n)))
    assert summarize_ranked(df.filter("false")).count() == 0


def test_two_sentences_where_there_are_two_and_nothing_private(spark):
    cv = "Rosa Quispe\nAv. Sol 3\nPERFIL\nRosa Quispe Mamani\nAv. Los Olmos 12, Cusco\nr@x.pe\nAnalista contable. {} Hace informes.\nIDIOMAS\nInglés: B2"
    rows = [(i, cv.format(s)) for i, s in enumerate(["Lidera equipos.", "Analista contable.", "Lidera equipos."])] + [(9, "Sin títulos. Nada más")]
    got = {r["doc_id"]: r["summary"] for r in summarize_ranked(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[9] == "" and all(len(got[i].split(". ")) == 2 for i in range(3))
    # Said twice is taken once.
    assert got[1] == "Analista contable. Hace informes."
    assert not any(w in s for s in got.values() for w in ("Quispe", "Olmos", "@", "Inglés"))


def test_words_beyond_the_common_ones_weigh_as_they_should(spark):
    rng = random.Random(5)
    sentence = lambda: " ".join(f"p{int(rng.paretovariate(0.5)) % 400}" for _ in range(rng.randint(1, 9))) + rng.choice(".!?")
    texts = [" ".join(sentence() for _ in range(rng.randint(1, 7))) for _ in range(120)]
    texts += [None, "", "única", "p1 p1. !!! zz", *texts[:9], " ".join(sentence() for _ in range(500))]
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    want = Counter((i // 2, s) for i, s in enumerate(by_hand(texts, 3)))
    for common in (1, 20, 1 << 16):
        assert Counter(tuple(r) for r in summarize_ranked(df, sentences=3, plain=True, common=common).collect()) == want


def test_a_corpus_of_common_words_shuffles_no_text(spark):
    df = spark.createDataFrame([(1, "uno dos. tres"), (2, "dos. cuatro")], "doc_id int, text string")
    plan = summarize_ranked(df, plain=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_no_pairs_of_rows(spark):
    df = spark.createDataFrame([(1, "uno dos. tres")], "doc_id int, text string")
    plan = summarize_ranked(df, plain=True)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan


def test_sentences_are_tried_once_for_each_taken_and_words_are_numbers(spark):
    df = spark.createDataFrame([(1, "uno dos. tres"), (2, "dos. cuatro")], "doc_id int, text string")
    plan = summarize_ranked(df, plain=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_max(") == 1 and "substring_index" not in plan


def test_keys_are_dealt_before_texts_are_cut(spark, monkeypatch):
    plans, packed = {}, ranked._packed

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return packed(df, name)

    monkeypatch.setattr(ranked, "_packed", kept)
    REGISTRY["summarize_ranked_cvs"](spark, "/root/testdata/sf0.001")
    above, below = plans["ranked-texts"].split("RoundRobinPartitioning")
    # One file of keys is one task, which must not cut all texts.
    assert "split(" in above and not any(f in below for f in ("split(", "RLIKE", "concat("))


def test_lines_are_judged_once(spark):
    df = spark.createDataFrame([(["Rosa Quispe", "Hace informes."],), (["- a", "Av. Sol 3"],), ([],), (None,)], "l array<string>")
    out = df.select(X.prose(F.col("l"), public=True).alias("p"))
    assert out._jdf.queryExecution().executedPlan().toString().count("RLIKE(") == 5
    assert [r["p"] for r in out.collect()] == [["Hace informes."], ["a"], [], None]


def test_long_runs_of_blanks_are_read_once(spark):
    run = F.repeat(F.lit(" "), 60_000)
    cuts = T.sentences(F.concat(F.lit("Uno."), run, F.lit("dos"), run, F.lit("tres\n cuatro")))
    listed = X.prose(F.array(F.concat(F.lit("-"), run), F.concat(F.lit("- a"), run)))
    began = time.monotonic()
    (row,) = spark.range(1).select(F.size(cuts).alias("n"), listed.alias("listed")).collect()
    assert time.monotonic() - began < 10
    assert row["n"] == 3 and [i.strip() for i in row["listed"]] == ["-"]
