"""Scalar functions against Python's own string methods."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from legajo.functions import text as T
from legajo.functions.errors import classify_error

STEMS = [
    "backend-python_senior", "o'neil dev2ops", "ANALISTA_de-datos", "ñandú-árbol", "", "a", "x_y-z",
    "ya Está", "straße", "ßeta", "中a文b", "1a2b", "ǆungla", "ªb ºc", "ﬁn",
]


def test_title(column):
    assert column(T.title_from_stem, STEMS) == [
        s.replace("-", " ").replace("_", " ").title() for s in STEMS
    ]


def test_title_or_stem(spark):
    rows = [(None, "a-b"), ("", "a-b"), (" ", "a-b"), ("Dado", "a-b")]
    df = spark.createDataFrame(rows, "t string, s string")
    out = df.select(T.title_or_stem(F.col("t"), F.col("s")).alias("o")).collect()
    assert [r["o"] for r in out] == ["A B", "A B", " ", "Dado"]


def test_title_fallback(column):
    values = [None, "", T.NO_TITLE, " ", "Jefe"]
    assert column(lambda c: T.title_fallback(c, F.lit("dado")), values) == ["dado"] * 3 + [" ", "Jefe"]


def test_line_preview(column):
    rng = random.Random(1)
    parts = ["a", "b", "\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", " ", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3_000)]
    assert column(T.line_preview, texts) == ["\n".join(t.splitlines()[:5]) for t in texts]


def test_truncate_counts_code_points(column):
    texts = ["😀é" * 2_000, "corto", ""]
    assert column(lambda c: T.truncate_text(c, T.CV_CHARS), texts) == [t[:3000] for t in texts]


def test_list_preview(column):
    lists = [["a", "b"], [], ["1", "2", "3", "4", "5", "6"]]
    assert column(T.list_preview, lists, "array<string>") == [", ".join(l[:5]) for l in lists]


def test_record_id(column):
    digest = hashlib.md5(b"sal|7").hexdigest()
    cuts = [digest[a:b] for a, b in ((0, 8), (8, 12), (12, 16), (16, 20), (20, 32))]
    first = column(lambda c: T.record_id(c, "sal"), [7, 8], "long")
    assert first[0] == "-".join(cuts) and first[0] != first[1]
    assert column(lambda c: T.record_id(c, "otra"), [7], "long")[0] != first[0]


def test_token_estimate(column):
    texts = ["Hola, mundo: 3.5%", "", "  ", "año_2 ¿qué?", "éx"]
    assert column(T.token_estimate, texts) == [len(re.findall(r"\w+|[^\w\s]", t)) for t in texts]


def test_leading_sentences(column):
    texts = ["Uno. Dos! Tres? Cuatro.", "Sin punto", "", "a.b c. d"]
    assert column(T.leading_sentences, texts) == ["Uno. Dos! Tres?", "Sin punto", "", "a.b c. d"]


def test_classify_error(spark):
    rows = [
        (None, None, "success"),
        ("ValueError", "x", "fatal"),
        ("BadRequestError", None, "fatal"),
        ("RateLimitError", "lento", "retryable"),
        ("RateLimitError", "bad API_KEY", "fatal"),
        ("Timeout", "Authentication failed", "fatal"),
        ("Timeout", "apiXkey", "retryable"),
    ]
    df = spark.createDataFrame(rows, "c string, m string, want string")
    for r in df.select(classify_error(F.col("c"), F.col("m")).alias("got"), "want").collect():
        assert r["got"] == r["want"]
