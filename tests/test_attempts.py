"""Outcomes against a walk through each log, also with one very busy request."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from legajo.operators.attempts import number_attempts, resolve_attempts

CALLS = [(None, None), ("ValueError", "x"), ("RateLimitError", "x"), ("Timeout", "bad api_key"), ("Timeout", None)]


def walk(calls, limit):
    """The retry rules, one call after another."""
    waited = 0
    for i, (kind, message) in enumerate(calls[:limit], start=1):
        if kind is None:
            return "ok", i, waited, kind, message
        if kind == "ValueError" or "api_key" in (message or "").lower():
            return "fatal", i, waited, kind, message
        if i == limit:
            return "exhausted", i, waited, kind, message
        waited += 2**i
    return "pending", i, waited, kind, message


def log_rows(n, rng, weights=(1, 1, 4, 1, 4)):
    rows = []
    for request in range(n):
        for t in range(rng.randint(1, 6)):
            kind, message = rng.choices(CALLS, weights)[0]
            rows.append((request, t, kind, message))
    rng.shuffle(rows)
    return rows


def expected(rows, limit):
    logs = defaultdict(list)
    for request, t, kind, message in sorted(rows, key=lambda r: r[:2]):
        logs[request].append((kind, message))
    return {r: walk(calls, limit) for r, calls in logs.items()}


@pytest.mark.parametrize("limit", [1, 2, 3, 5])
def test_outcomes(spark, limit):
    rows = log_rows(500, random.Random(limit))
    rows += [(10_000, t, "Timeout", None) for t in range(900)]
    df = spark.createDataFrame(rows, "r long, t int, error_class string, message string").repartition(8)
    out = resolve_attempts(number_attempts(df, "r", ["t"], limit), "r", limit).collect()
    assert {r["r"]: tuple(r)[1:] for r in out} == expected(rows, limit)


def test_a_fatal_last_attempt_is_fatal(spark):
    rows = [(1, 1, "Timeout", None), (1, 2, "Timeout", None), (1, 3, "ValueError", None)]
    df = spark.createDataFrame(rows, "r long, attempt int, error_class string, message string")
    out = resolve_attempts(df, "r").first()
    assert tuple(out)[1:] == ("fatal", 3, 6, "ValueError", None)


def test_no_attempts_allowed(spark):
    df = spark.createDataFrame([], "r long, attempt int, error_class string, message string")
    with pytest.raises(ValueError):
        resolve_attempts(df, "r", 0)


def test_group_limit_runs_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("r"), F.col("id").alias("t"))
    plan = number_attempts(df, "r", ["t"])._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > shuffle
