"""Top matches against scores of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from legajo.functions.contract import DEGREES
from legajo.operators import match

CV = "cv long, skills array<string>, years double, degree string, score int, term string"
JD = "jd long, must array<string>, nice array<string>, years double, degree string, rank int, weight string"


def points(cv, jd):
    must, nice = set(jd[1] or ()) - {None}, set(jd[2] or ()) - {None}
    nice -= must
    has = set(cv[1] or ()) - {None}
    m, n, weight = len(must & has), len(nice & has), 2 * len(must) + len(nice)
    tenths = lambda y: max(0, round((y or 0) * 10 + 1e-9))
    rank = lambda d: DEGREES.index(d) + 1 if d in DEGREES else 0
    asked = tenths(jd[3])
    years = 200 if not asked else 200 * min(tenths(cv[2]), asked) // asked
    return (700 * (2 * m + n) // weight + years + (100 if rank(cv[3]) >= rank(jd[4]) else 0), m, n) if m + n else None


def brute(cvs, jds, k):
    out = set()
    for jd in jds:
        if jd[0] is None:
            continue
        scored = {(-p[0], cv[0], p[1], p[2]) for cv in cvs if cv[0] is not None and (p := points(cv, jd))}
        out |= {(jd[0], rank, cv, -s, m, n) for rank, (s, cv, m, n) in enumerate(sorted(scored)[:k], 1)}
    return out


def corpus(seed, n_cvs, n_jds, hot):
    rng = random.Random(seed)
    skills = [f"s{i}" for i in range(25)]
    pick = lambda n: rng.sample(skills, rng.randint(0, n)) + (["hot"] if hot and rng.random() < hot else [])
    degree = lambda: rng.choice([None, "ninguno", *DEGREES])
    cvs = [(i, pick(6), rng.choice([None, 0.0, 2.5, 7.0, -1.0]), degree(), 3, "z") for i in range(n_cvs)]
    jds = [(i, pick(4), pick(3), rng.choice([None, 0.0, 3.0, 10.0]), degree(), 1, "z") for i in range(n_jds)]
    cvs += [(n_cvs, None, 1.0, None, 3, "z"), (None, ["s1"], 1.0, None, 3, "z"), (n_cvs + 1, ["s1", None, "s1"], 1.0, None, 3, "z")] + cvs[:20]
    jds += [(n_jds, None, None, 1.0, None, 1, "z"), (None, ["s1"], [], 1.0, None, 1, "z"), (n_jds + 1, ["s1", None], ["s1", "s2"], 1.0, None, 1, "z")] + jds[:5]
    return cvs, jds


@pytest.mark.parametrize("seed,hot,k,block", [(1, 0, 3, 4096), (2, 1.0, 5, 16), (3, 0.9, 1, 7)])
def test_all_pairs(spark, seed, hot, k, block):
    cvs, jds = corpus(seed, 500, 150, hot)
    got = match.top_matches(spark.createDataFrame(cvs, CV).repartition(5), spark.createDataFrame(jds, JD).repartition(3), k, block)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(cvs, jds, k)


def test_a_skill_that_every_cv_has_is_split_and_mostly_left_alone(spark, monkeypatch):
    rng = random.Random(9)
    cvs = [(i, ["hot", f"s{rng.randrange(40)}", f"s{rng.randrange(40)}"], float(i % 50), "bachiller", 3, "z") for i in range(3000)]
    jds = [(i, ["hot", f"s{i}"], [], 1.0, None, 1, "z") for i in range(40)] + [(40, ["hot"], [], 1.0, None, 1, "z")]
    seen = []
    met = match._met
    monkeypatch.setattr(match, "_met", lambda probes, index, block: seen.append((probes, index, met(probes, index, block))) or seen[-1][2])
    got = match.top_matches(spark.createDataFrame(cvs, CV), spark.createDataFrame(jds, JD), 5, 64)
    assert {tuple(r) for r in got.collect()} == brute(cvs, jds, 5)
    # The rare skill decides; of 41 descriptions only the one that asks for nothing else looks up the frequent one.
    asked = [r["term"] for probes, _, _ in seen for r in probes.select("term").collect()]
    assert asked.count("hot") == 1
    index = seen[0][1]
    dealt = index.filter("term = 'hot'").groupBy(F.pmod(F.xxhash64("cv_class"), F.col("cv_blocks"))).count().collect()
    assert len(dealt) > 10 and max(r["count"] for r in dealt) < 200
    plan = seen[0][2]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_sides(spark):
    cvs, jds = corpus(4, 10, 5, 0)
    a, b = spark.createDataFrame(cvs, CV), spark.createDataFrame(jds, JD)
    assert match.top_matches(a.limit(0), b).count() == 0 and match.top_matches(a, b.limit(0)).count() == 0
