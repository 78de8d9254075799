"""Requests: cut after masking, ids, payloads, roll-ups."""

import json

import pytest
from pyspark.sql import functions as F

from legajo.functions import text as T
from legajo.functions.contract import CV_RULES
from legajo.operators import requests
from legajo.operators.anonymize import anonymize


def test_the_cut_comes_after_masking(spark):
    text = "una dos tres cuatro cinco seis " + "x" * 2_965 + " 12345678 fin"
    df = anonymize(spark.createDataFrame([(1, text)], "doc_id int, text string"))
    user = requests.render_cv_request(df, "s", user="%s|%s").first()["user"]
    cut, rid = user.split("|")
    assert len(cut) == T.CV_CHARS and "1234" not in cut and cut.endswith(" [DN")
    assert len(rid) == 36


def test_request_of_a_job_description(spark):
    df = spark.createDataFrame([(1, "t" * 5_000, None), (2, "juan@x.pe", "Jefe %s")], "doc_id int, text string, title string")
    rows = requests.render_jd_request(df, "s").orderBy("doc_id").collect()
    assert T.NO_TITLE in rows[0]["user"] and rows[0]["user"].count("t" * T.JD_CHARS) == 1
    assert "t" * (T.JD_CHARS + 1) not in rows[0]["user"]
    assert "juan@x.pe" in rows[1]["user"] and "Jefe %s" in rows[1]["user"]
    assert rows[1]["max_tokens"] == 800 and rows[1]["record_id"] in rows[1]["user"]


def test_payloads(spark):
    df = anonymize(spark.createDataFrame([(1, "a\nb")], "doc_id int, text string"))
    sent = requests.render_cv_request(df, "s")
    row = requests.with_payload(sent, "chat", requests.json_schema(CV_RULES)).first()
    body = json.loads(row["payload"])
    assert [m["role"] for m in body["messages"]] == ["system", "user"]
    assert body["messages"][1]["content"] == row["user"] and body["temperature"] == 0.0
    assert json.loads(body["response_schema"])["type"] == "object"
    single = json.loads(requests.with_payload(sent, "prompt").first()["payload"])
    assert single["prompt"] == f"{row['system']}\n\n{row['user']}" and "response_schema" not in single
    with pytest.raises(ValueError):
        requests.with_payload(sent, "otro")


def test_rollup_of_a_hot_group(spark):
    rows = [("es", 10)] * 600 + [("en", 1), ("en", 4)]
    df = spark.createDataFrame(rows, "lang string, tokens long").repartition(8)
    got = {r["lang"]: tuple(r)[1:] for r in requests.token_rollup(df, ["lang"], 0.5).collect()}
    assert got == {"es": (600, 6_000, 10.0, 10, 3.0), "en": (2, 5, 2.5, 4, 0.0025)}


def test_tokens_count_both_parts(spark):
    df = spark.createDataFrame([("uno dos.", "tres")], "system string, user string")
    assert requests.with_tokens(df).first()["tokens"] == 4
    assert df.select(T.token_estimate(F.col("user"))).first()[0] == 1


def test_documents_without_text_are_set_aside(spark):
    from legajo.operators.requests import render_cv_request, sendable, with_model, with_payload

    df = spark.createDataFrame([(1, None), (2, " \n"), (3, "hola")], "doc_id long, text_anon string")
    asked, empty = sendable(render_cv_request(df, "s"))
    assert [r["doc_id"] for r in asked.collect()] == [3] and sorted(r["doc_id"] for r in empty.collect()) == [1, 2]
    body = with_payload(with_model(asked, "casa", "m1"), "chat").first()
    assert json.loads(body["payload"])["model"] == "m1" and body["provider"] == "casa"
