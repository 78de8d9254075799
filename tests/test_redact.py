"""Masking against golden cases and a plain-Python model of its rules."""

import random
import re

import pytest

from legajo.functions import redact as R
from legajo.operators.anonymize import anonymize, pii_audit

E, D, U, T, N = R.EMAIL_TAG, R.DNI_TAG, R.RUC_TAG, R.PHONE_TAG, R.NAME_TAG

WHOLE = [
    ("", N),
    ("\nInés Soto\nDNI: 80011122", f"{N}\nInés Soto\nDNI: {D}"),
    ("Juan\r\nDNI 12345678", f"{N}\nDNI {D}"),
    ("una dos tres cuatro cinco seis\nx", "una dos tres cuatro cinco seis\nx"),
    ("una dos tres cuatro cinco", N),
]
FRAGMENTS = [
    ("+51 912340056", f"+51 {T}"),
    ("+51912340056", f"+{U}"),
    ("x+51 912340056", f"x{T}"),
    ("x+51\n912340056", f"x{T}"),
    ("14441234", D),
    ("1000000", T),
    ("123456789", "123456789"),
    ("987 654 321", "987 654 321"),
    ("a@b.my-host.com", f"{E}-host.com"),
    ("12345678@x.com", E),
    ("_12345678 ñ12345678", "_12345678 ñ12345678"),
    ("20123456789", U),
    ("a@b.c-d@e.f", f"{E}{E}"),
    ("josé.ñ+x@mi-correo.pe.", f"{E}."),
]


# What counts as personal data, in Python's regex dialect.
KINDS = {
    "emails": (r"\b[\w.+-]+@[\w-]+\.[\w.]+\b", E),
    "dnis": (r"\b\d{8}\b", D),
    "rucs": (r"\b\d{11}\b", U),
    "phones": (r"\b(?:\+51\s?)?(?:9\d{8}|\d{7,8})\b", T),
}


def by_hand(text: str) -> str:
    """The rules with Python's own Unicode regexes."""
    for pattern, tag in KINDS.values():
        text = re.sub(pattern, tag, text)
    head, mark, rest = text.partition("\n")
    return f"{N}{mark}{rest}" if len(head.split()) <= 5 else text


PIECES = [
    "a", "é", "_", "9", "12345678", "987654321", "20123456789", "1234567", "+51", "+51 ", "+51\n", "+",
    "@", ".", "-", "x.y", "@b.c", " ", "\n", "\r", "\t", "\x1c", "\x1f", "\x85", " ", " ", "́",
    "²", "𝐀", "😀", "𝟗", "١٢٣٤٥٦٧٨", "ñ", "palabra", "(", ")", ",", ":", "½", "Ⅷ", "漢",
]


def fuzz(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 24))) for _ in range(n)]


def masked(spark, texts, **options):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "i int, text string").repartition(8)
    out = anonymize(df, **options).select("i", "text_anon").collect()
    return [r["text_anon"] for r in sorted(out, key=lambda r: r["i"])]


def test_golden(spark):
    lead = "una dos tres cuatro cinco seis\n"
    texts = [t for t, _ in WHOLE] + [lead + t for t, _ in FRAGMENTS]
    expected = [e for _, e in WHOLE] + [lead + e for _, e in FRAGMENTS]
    assert [by_hand(t) for t in texts] == expected
    assert masked(spark, texts) == expected


def test_fuzz_against_python(spark):
    texts = fuzz(20_000, seed=7)
    wrong = [(t, m, by_hand(t)) for t, m in zip(texts, masked(spark, texts)) if m != by_hand(t)]
    assert not wrong, wrong[:3]


def test_single_rules(column):
    texts = fuzz(3_000, seed=8)
    rules = (R.redact_email, R.redact_dni, R.redact_ruc, R.redact_phone)
    for fn, (pattern, tag) in zip(rules, KINDS.values()):
        assert column(fn, texts) == [re.sub(pattern, tag, t) for t in texts]


def test_masking_twice_changes_nothing_but_the_name(spark):
    once = masked(spark, ["una dos tres cuatro cinco seis " + t for t in fuzz(2_000, seed=9)])
    assert masked(spark, once) == once


def test_null_stays_null(spark):
    assert masked(spark, [None]) == [None]


def test_skip_blank_lead(spark):
    text = " \n\nJuan Perez\nDNI: 47123456"
    assert masked(spark, [text], skip_blank_lead=True) == [f"{N}\nDNI: {D}"]


def test_long_line_without_match(spark):
    text = "a." * 50_000
    assert masked(spark, [text + "@"]) == [N]
    assert masked(spark, ["a b c d e f\n" + text]) == ["a b c d e f\n" + text]


@pytest.mark.parametrize("hot", [0, 900])
def test_audit_counts(spark, hot):
    texts = fuzz(1_500, seed=10) + ["x @ [EMAIL_REDACTADO] a@b.c 12345678"] * hot
    rows = [("a" if i % 3 else "b", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "grp string, text string").repartition(8)
    got = {r["grp"]: r.asDict() for r in pii_audit(df, ["grp"]).collect()}
    for grp in "ab":
        want = dict(docs=0, emails=0, dnis=0, rucs=0, phones=0, names=0, left_over=0)
        for g, t in rows:
            if g != grp:
                continue
            want["docs"] += 1
            for key, (pattern, tag) in KINDS.items():
                t, n = re.subn(pattern, tag, t)
                want[key] += n
            want["names"] += len(t.partition("\n")[0].split()) <= 5
        assert got[grp] == {"grp": grp, **want}
