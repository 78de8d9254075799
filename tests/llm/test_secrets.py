"""Candidates against a loop, the forest against findings it has not seen."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from legajo.llm import secrets


@pytest.fixture(scope="module")
def forest(spark):
    return secrets.fit(secrets.drawn_findings(spark))


def digest(i):
    return hashlib.sha1(str(i).encode()).hexdigest()


def test_candidates(spark):
    rows = [
        (1, f'a token = "{digest(1)}" b', "s"), (2, f"x{digest(2)}|{digest(3)}", None), (3, None, "s"), (4, "", "s"), (5, "palabra " * 5_000, "s"),
        (6, "4417744280351547 fin", "a/test/b"), (6, "4417744280351547 fin", "a/test/b"), (7, "z" * 50_000 + " ABCdefGHIjklMNOpq", "s"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, candidate string")
    got = secrets.candidates(df).collect()
    want = []
    for doc, text, _ in rows:
        for word in (text or "").split():
            for c in re.findall(r"[A-Za-z0-9+/_=-]{16,}", word):
                if re.search("[0-9]", c) or re.search("[a-z][A-Z]", c) and re.search("[A-Z][a-z]", c):
                    want.append((doc, c))
    assert sorted((r["doc_id"], r["candidate"]) for r in got) == sorted(want)
    first = next(r for r in got if r["doc_id"] == 1)
    assert (first["before"], first["after"]) == ('a token = "', '" b')
    assert secrets.candidates(df.filter("false")).count() == 0


def test_held_out_findings(spark, forest):
    unseen = secrets.drawn_findings(spark, 2_000).filter(F.pmod(F.crc32("candidate"), F.lit(3)) == 0)
    judged = secrets.judged(unseen, forest).groupBy("label", "is_secret").count().collect()
    n = {(r["label"], r["is_secret"]): r["count"] for r in judged}
    assert n.get((1, False), 0) <= 0.02 * n[1, True] and n.get((0, True), 0) <= 0.02 * n[0, False]
    none = spark.createDataFrame([(None, None, None, None)], "candidate string, before string, after string, path string")
    assert secrets.judged(none, forest).first()["is_secret"] is False


def test_masking_takes_secrets_and_nothing_else(spark, forest):
    clean = f"el commit {digest(9)} y la tarjeta 4417744280351547 de Constantinopolitanamente"
    rows = [(1, f'token = "{digest(1)}" y {digest(1)}', "s", 9), (None, f"api_key: {digest(2)}", None, 9), (3, clean, "s", 9), (4, None, "s", 9), (4, None, "s", 9), (1, f'token = "{digest(1)}"', "s", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    out = secrets.masked(df, forest)
    got = sorted((str(r["text"]) for r in out.collect()))
    assert out.columns == df.columns
    assert got == sorted(["None", "None", 'token = "[secret]" y [secret]', "api_key: [secret]", clean, 'token = "[secret]"'])


def test_short_and_signed_values_are_masked(spark, forest):
    texts = {
        'password = "Tr0ub4dor&3"': 'password = "[secret]"',
        'x client_secret = "p@ss.W0rd!2024$x" y': 'x client_secret = "[secret]" y',
        "api_key: k3J9xQ2mZ7pL y": "api_key: [secret] y",
        'token = "qzkfhwmrtbxplcvdkq"': 'token = "[secret]"',
        "AUTH_TOKEN=f7!aQ9$zX, Tr0ub4dor": "AUTH_TOKEN=[secret] Tr0ub4dor",
        "password: required": None,
        "the token: verment and more": None,
        "author: Tr0ub4dor&3": None,
    }
    df = spark.createDataFrame([(i, t, "conf") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["text"] for r in secrets.masked(df, forest).collect()}
    assert got == {i: want or t for i, (t, want) in enumerate(texts.items())}
    found = secrets.candidates(df).filter("doc_id = 1").collect()
    assert [(r["candidate"], r["before"], r["after"]) for r in found] == [("p@ss.W0rd!2024$x", 'x client_secret = "', '" y')]
