"""What became of each request, from a log of its attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from legajo.functions.errors import classify_error

# Fixed value: attempts per request.
MAX_ATTEMPTS = 3


def number_attempts(log: DataFrame, request: str | list[str], order: list[str], max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Keep each request's first ``max_attempts`` log rows, numbered ``attempt``.

    No later attempt is ever made. Spark applies the limit on both sides of the
    shuffle, so a request with a huge log sends ``max_attempts`` rows per task.
    """
    keys = [request] if isinstance(request, str) else request
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return log.withColumn("attempt", rank).filter(F.col("attempt") <= max_attempts)


def resolve_attempts(
    log: DataFrame,
    request: str | list[str],
    max_attempts: int = MAX_ATTEMPTS,
    *,
    attempt: str = "attempt",
    error_class: str = "error_class",
    message: str = "message",
) -> DataFrame:
    """One outcome per request from its numbered attempts.

    The first success gives ``ok``, the first fatal error ``fatal``, a retryable
    error on the last attempt ``exhausted``; without any of them the request is
    ``pending``. ``wait_s`` is the sum of 2^i seconds after each failed attempt
    i that is followed by another; ``error_class`` and ``message`` are those of
    the attempt that decided. The fatal test comes before the exhausted one. A single aggregate that combines map-side: no rows of a request are
    gathered.
    """
    if max_attempts < 1:
        raise ValueError("max_attempts must be at least 1")
    keys = [request] if isinstance(request, str) else request
    n = F.col(attempt)
    verdict = classify_error(F.col(error_class), F.col(message))
    steps = log.filter(n <= max_attempts).select(
        *keys,
        n.alias("_n"),
        verdict.alias("_verdict"),
        F.col(error_class).alias("error_class"),
        F.col(message).alias("message"),
    )
    step = F.struct("_n", "_verdict", "error_class", "message")
    ends = (F.col("_verdict") != "retryable") | (F.col("_n") == max_attempts)
    grouped = steps.groupBy(*keys).agg(
        F.min(F.when(ends, step)).alias("_end"), F.max(step).alias("_last")
    )
    decided = F.coalesce(F.col("_end"), F.col("_last"))
    done = grouped.select(*keys, F.col("_end").isNull().alias("_open"), decided.alias("_step"))
    outcome = (
        F.when(F.col("_open"), "pending")
        .when(F.col("_step._verdict") == "success", "ok")
        .when(F.col("_step._verdict") == "fatal", "fatal")
        .otherwise("exhausted")
    )
    # 2 + 4 + ... + 2^k is 2^(k+1) - 2; the ending attempt is followed by no wait.
    used = F.col("_step._n")
    waits = F.when(F.col("_open"), used).otherwise(used - 1)
    return done.select(
        *keys,
        outcome.alias("outcome"),
        used.cast("long").alias("attempts"),
        (F.pow(F.lit(2), waits + 1) - 2).cast("long").alias("wait_s"),
        "_step.error_class",
        "_step.message",
    )
