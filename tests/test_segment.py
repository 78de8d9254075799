"""The line segmenter against all labellings, and on odd texts."""

import itertools
import random

from pyspark.sql import functions as F

from legajo.operators import segment
from legajo.plans import corpora as C

SF = "/root/testdata/sf0.001"


def random_costs(seed):
    rng = random.Random(seed)
    n, k = len(segment.PARTS), segment._N_KINDS
    row = lambda most: [rng.randint(1, most) for _ in range(k)]
    return segment.Costs([rng.randint(1, 900) for _ in range(n)], [rng.randint(1, 900) for _ in range(n)], [row(5000) for _ in range(n)], [row(5000) for _ in range(n)])


def cost_of(labels, kinds, c):
    """``labels``: (part, entered) of each line."""
    total, at = 0, 0
    for (part, entered), k in zip(labels, kinds):
        total += c.enter[part] + c.first[part][k] if entered else c.stay[part] + c.other[part][k]
        if not entered and part != at or entered and part == 0:
            return None
        at = part
    return total


def test_cheapest_of_all_labellings(column):
    rng = random.Random(3)
    c = random_costs(1)
    # Few parts, so that all labellings can be tried.
    far = [10**7] * len(c.enter)
    c = segment.Costs([*c.enter[:3], *far[3:]], c.stay, c.first, c.other)
    cases = [[rng.randrange(segment._N_KINDS) for _ in range(rng.randint(1, 6))] for _ in range(40)]
    got = column(lambda k: segment.labelled(k, c), cases, "array<int>")
    for kinds, path in zip(cases, got):
        every = itertools.product([(0, False), (1, False), (1, True), (2, False), (2, True)], repeat=len(kinds))
        costs = [cost_of(labels, kinds, c) for labels in every]
        starts = {r["start"]: r["part"] for r in path[1:]}
        labels, part = [], 0
        for i in range(len(kinds)):
            part = starts.get(i, part)
            labels.append((part, i in starts))
        assert cost_of(labels, kinds, c) == min(x for x in costs if x is not None)


def test_known_and_unknown_headings(spark):
    costs = segment.learn(C.free_cv_corpus(spark, SF))
    text = "Eva Ruiz\n\nPERFIL\nContadora con ganas de viajar y aprender cosas.\n\nMi camino\n2019 - 2021: Jefa — Sur\n- Informes\n\nIdiomas\nInglés: B2"
    strange = text.replace("PERFIL", "Quién soy").replace("Idiomas", "Lenguas")
    rows = [(1, text), (2, strange.replace("\n", "\r\n")), (2, strange.replace("\n", "\r\n")), (3, None), (4, ""), (5, "\n" * 50), (None, "x " * 20_000), (6, "PERFIL\nUna frase.")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id int, text string, sections int").drop("sections")
    out = segment.segmented(df, costs).collect()
    got = [(r["doc_id"], r["sections"] and [(s["start"], s["section"]) for s in r["sections"]]) for r in out]
    want = [(0, "lead"), (2, "profile"), (5, "experience"), (9, "languages")]
    assert got[:4] == [(1, want), (2, want), (2, want), (3, None)]
    assert got[4:] == [(4, [(0, "lead")]), (5, [(0, "lead")]), (None, [(0, got[6][1][0][1])]), (6, [(0, "profile")])]
    for r, (_, value) in zip(out, rows):
        if value is not None:
            lines = [line for s in r["sections"] for line in s["lines"]]
            assert lines == value.replace("\r\n", "\n").split("\n")


def test_costs_of_an_empty_table(spark):
    costs = segment.learn(spark.createDataFrame([(None,)], "text string"))
    df = spark.createDataFrame([("IDIOMAS\nInglés: B2",)], "text string")
    sections = segment.segmented(df, costs).first()["sections"]
    assert [s["section"] for s in sections][-1] == "languages"


def test_a_line_is_folded_once_to_find_its_kind(spark):
    # Lambdas share nothing: an expression that nine branches read would be computed in each.
    plan = lambda c: spark.range(1).selectExpr("array('a') AS lines").select(c.alias("kinds"))._jdf.queryExecution().analyzed().toString()
    assert plan(segment.kinds(F.col("lines"))).count("translate(lower(") == 1
