"""Replies matched to the requests they answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def correlate_responses(
    requests: DataFrame,
    responses: DataFrame,
    *,
    doc: str = "doc_id",
    record: str = "record_id",
    echoed: str = "rid",
) -> DataFrame:
    """Every reply and every unanswered request, with a ``status``.

    ``matched``: the reply repeats its request's id. ``id_mismatch``: it has
    another one or none. ``unknown``: no such request. ``repeated``: the document
    was asked about more than once, so the reply cannot be told to belong to one
    of the requests. ``unanswered``: a request without a reply. Each reply comes
    out once.

    A plain left join: a document with very many replies, or very many replies
    without a document, is divided by adaptive skew handling, which never
    depends on how rows are numbered.
    """
    ids = requests.groupBy(doc).agg(F.min(record).alias("_expected"), F.count("*").alias("_asked"))
    replies = responses.join(ids, doc, "left")
    status = (
        F.when(F.col("_asked").isNull(), "unknown")
        .when(F.col("_asked") > 1, "repeated")
        .when(F.col(echoed) == F.col("_expected"), "matched")
        .otherwise("id_mismatch")
    )
    silent = requests.join(responses.select(doc), doc, "left_anti").select(
        doc, F.col(record).alias("_expected"), F.lit("unanswered").alias("status")
    )
    return (
        replies.withColumn("status", status)
        .drop("_asked")
        .unionByName(silent, allowMissingColumns=True)
        .withColumnRenamed("_expected", record)
    )
