"""From masked documents to requests, and from replies to checked records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legajo.functions import text as T
from legajo.functions.contract import CV_RULES, JD_RULES
from legajo.operators import requests, validate
from legajo.operators.anonymize import anonymize
from legajo.operators.attempts import number_attempts, resolve_attempts
from legajo.operators.correlate import correlate_responses
from legajo.sources import sinks


def cv_requests(docs: DataFrame, salt: str, provider: str, model: str, style: str = "chat", doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(requests with payload and token estimate, documents without text)."""
    asked, empty = requests.sendable(requests.render_cv_request(anonymize(docs), salt, doc))
    asked = requests.with_tokens(requests.with_model(asked, provider, model))
    return requests.with_payload(asked, style, requests.json_schema(CV_RULES)), empty


def jd_records(asked: DataFrame, replies: DataFrame, titles: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(``doc``, status, record, errors) of replies about job descriptions.

    Each reply is met with its request; only one that repeats the request's id can give a record, others fail with their
    status as the error. A row without a body is no reply. An empty or placeholder title gives way to the one in ``titles`` (``doc``, title).
    """
    met = correlate_responses(asked, replies.filter("body is not null"), doc=doc)
    checked = validate.validate_response(met, JD_RULES).join(titles.select(doc, "title"), doc, "left")
    title = T.title_fallback(F.col("record.titulo_puesto"), F.col("title"))
    matched = F.col("status") == "matched"
    record = F.when(matched, F.when(F.col("record").isNotNull(), F.col("record").withField("titulo_puesto", title)))
    errors = F.when(matched, F.col("errors")).otherwise(F.array("status"))
    return checked.select(doc, "status", record.alias("record"), errors.alias("errors"))


def cv_records(asked: DataFrame, log: DataFrame, replies: DataFrame, order: list[str], doc: str = "doc_id") -> DataFrame:
    """(``doc``, record_id, status, attempts, wait_s, body, record, errors): what became of each request about a CV.

    ``asked`` has ``doc`` and record_id, ``log`` a row per attempt with ``doc``, ``order``, error_class and message, ``replies`` ``doc``, rid and
    body; a row without a body is no reply. The attempts are resolved first: a request that they end as ``fatal``, ``exhausted`` or ``pending``
    has that status and gives no record, whatever came in for it. Else the status is that of ``correlate_responses``, and only a ``matched`` reply
    that passes the record contract gives a record; the errors of all others are their status. Requests and
    replies come out once each; requests that nothing is logged of have no attempts.
    """
    ends = resolve_attempts(number_attempts(log, doc, order), doc).select(doc, "outcome", "attempts", "wait_s")
    met = correlate_responses(asked, replies.filter("body is not null"), doc=doc).join(ends, doc, "left")
    failed = F.col("outcome").isNotNull() & (F.col("outcome") != "ok")
    met = met.withColumn("status", F.when(failed, F.col("outcome")).otherwise(F.col("status")))
    checked = validate.validate_response(met, CV_RULES)
    matched = F.col("status") == "matched"
    return checked.select(
        doc, "record_id", "status", "attempts", "wait_s", "body",
        F.when(matched, F.col("record")).alias("record"),
        F.when(matched, F.col("errors")).otherwise(F.array("status")).alias("errors"),
    )


def write_cv_records(built: DataFrame, folder: str) -> None:
    """``folder/records``: one JSON record a line; ``folder/quarantine``: what gave none, as JSON with its reply and errors.

    All is checked once and kept in ``folder/sides``. The folder must not exist yet.
    """
    good, bad = validate.split_quarantine(built, f"{folder}/sides")
    sinks.write_records_json(good, f"{folder}/records")
    bad.drop("record").write.json(f"{folder}/quarantine")
