"""Model requests as a table, with token estimates and cost roll-ups."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions import text as T
from legajo.functions.contract import FieldRule
from legajo.functions.patterns import SPACE

# Reply limits of the two kinds of request and of any other, and
# the temperature.
CV_MAX_TOKENS = 1200
JD_MAX_TOKENS = 800
MAX_TOKENS = 1500
TEMPERATURE = 0.0

# Wording is ours and can be replaced by the caller.
CV_SYSTEM = (
    "Lees hojas de vida ya enmascaradas y devuelves un registro JSON. "
    "No escribas nombres, documentos, teléfonos, correos ni direcciones."
)
CV_USER = "Hoja de vida:\n%s\n\nUsa este candidato_id: %s"
JD_SYSTEM = (
    "Lees avisos de empleo y devuelves un registro JSON. "
    "Separa lo obligatorio de lo deseable."
)
JD_USER = "Título de referencia: %s\nAviso:\n%s\n\nUsa este jd_id: %s"


def render_request(
    df: DataFrame,
    doc: str,
    record_id: Column,
    system: str,
    user: Column,
    max_tokens: int = MAX_TOKENS,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """(``doc``, record_id, system, user, max_tokens, temperature) for any task."""
    return df.select(
        F.col(doc),
        record_id.alias("record_id"),
        F.lit(system).alias("system"),
        user.alias("user"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(temperature).alias("temperature"),
    )


def _if_text(text: str, filled: Column) -> Column:
    return F.when(F.rlike(F.col(text), F.lit(rf"[^{SPACE}]")), filled)


def sendable(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests to send, quarantined ones whose document has no text)."""
    asked = F.col("user").isNotNull()
    return requests.filter(asked), requests.filter(~asked)


def with_model(requests: DataFrame, provider: str, model: str) -> DataFrame:
    """Add ``provider`` and ``model``, for ``with_payload`` and for roll-ups by model."""
    return requests.withColumns({"provider": F.lit(provider), "model": F.lit(model)})


def render_cv_request(
    df: DataFrame,
    salt: str,
    doc: str = "doc_id",
    text: str = "text_anon",
    *,
    system: str = CV_SYSTEM,
    user: str = CV_USER,
    chars: int = T.CV_CHARS,
    max_tokens: int = CV_MAX_TOKENS,
) -> DataFrame:
    """One request per masked CV; ``user`` takes the cut text and the id.

    A row without text has no ``user``: see ``sendable``.
    """
    rid = T.record_id(F.col(doc), salt)
    filled = F.format_string(user, T.truncate_text(F.col(text), chars), rid)
    return render_request(df, doc, rid, system, _if_text(text, filled), max_tokens)


def render_jd_request(
    df: DataFrame,
    salt: str,
    doc: str = "doc_id",
    text: str = "text",
    title: str = "title",
    *,
    system: str = JD_SYSTEM,
    user: str = JD_USER,
    chars: int = T.JD_CHARS,
    max_tokens: int = JD_MAX_TOKENS,
) -> DataFrame:
    """One request per job description, which is not masked.

    ``user`` takes the title hint, the cut text and the id. A row without text
    has no ``user``: see ``sendable``.
    """
    rid = T.record_id(F.col(doc), salt)
    hint = F.coalesce(F.col(title), F.lit(T.NO_TITLE))
    filled = F.format_string(user, hint, T.truncate_text(F.col(text), chars), rid)
    return render_request(df, doc, rid, system, _if_text(text, filled), max_tokens)


def with_tokens(requests: DataFrame, out: str = "tokens") -> DataFrame:
    """Add the token estimate of system and user text together."""
    return requests.withColumn(out, T.token_estimate(F.concat("system", "user")))


def json_schema(rules: Iterable[FieldRule]) -> str:
    """The record's JSON schema, for callers that ask the model for one."""
    kinds = {
        "str": {"type": "string"},
        "enum": {"type": "string"},
        "float": {"type": "number"},
        "list_str": {"type": "array", "items": {"type": "string"}},
    }
    fields, required = {}, []
    for rule in rules:
        if rule.kind == "list_struct":
            members = {m: {"type": "string"} for m in rule.members}
            item = {"type": "object", "properties": members, "required": list(members)}
            field = {"type": "array", "items": item}
        else:
            field = dict(kinds[rule.kind])
        if rule.values:
            field["enum"] = list(rule.values)
        if rule.minimum is not None:
            field["minimum"] = rule.minimum
        fields[rule.name] = field
        if not rule.optional:
            required.append(rule.name)
    return json.dumps({"type": "object", "properties": fields, "required": required}, ensure_ascii=False)


def with_payload(requests: DataFrame, style: str, schema: str | None = None, out: str = "payload") -> DataFrame:
    """Add the JSON body for a model endpoint.

    ``chat`` gives two messages, ``prompt`` one text of both parts; ``schema``
    is the JSON schema the reply must follow; a ``model`` column goes along.
    """
    if style == "chat":
        message = lambda role, text: F.struct(F.lit(role).alias("role"), F.col(text).alias("content"))
        head = F.array(message("system", "system"), message("user", "user")).alias("messages")
    elif style == "prompt":
        head = F.concat_ws("\n\n", "system", "user").alias("prompt")
    else:
        raise ValueError(f"unknown request style: {style}")
    extra = [] if schema is None else [F.lit(schema).alias("response_schema")]
    if "model" in requests.columns:
        extra.append(F.col("model"))
    body = F.struct(head, F.col("max_tokens"), F.col("temperature"), *extra)
    return requests.withColumn(out, F.to_json(body))


def token_rollup(requests: DataFrame, by: list[str], price_per_1k: float, tokens: str = "tokens") -> DataFrame:
    """Total, mean and largest token estimate and the cost, per group."""
    total = F.sum(tokens)
    return requests.groupBy(*by).agg(
        F.count("*").alias("requests"),
        total.alias("tokens_total"),
        F.avg(tokens).alias("tokens_mean"),
        F.max(tokens).alias("tokens_max"),
        (total / F.lit(1000) * F.lit(price_per_1k)).alias("cost"),
    )
