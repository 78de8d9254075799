"""Extraction against plain-Python readings of the same texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from legajo.functions import extract as X
from legajo.functions import lexicon as L
from legajo.operators import extract

LINES = ["PERFIL", "IDIOMAS:", "ABC", " ABCD", "a", "", "- x", "ÁÉÍÓ ÑU", "ABCD:x", "2020 - 2021: A — B", "    "]


def texts(n, seed):
    rng = random.Random(seed)
    return ["\n".join(rng.choices(LINES, k=rng.randint(0, 12))) for _ in range(n)]


def test_sections_carry_the_last_heading(spark):
    docs = texts(500, 1) + ["\n".join(["IDIOMAS", "x"] * 3_000)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string").repartition(8)
    want = set()
    for i, text in enumerate(docs):
        section = None
        for pos, line in enumerate(text.split("\n")):
            if re.fullmatch(r"[A-ZÁÉÍÓÚÑ ]+:?", line) and sum(map(str.isupper, line)) >= 4:
                section = line.rstrip(":").strip()
            want.add((i, pos, line, section))
    got = [tuple(r) for r in extract.tag_sections(df).collect()]
    assert len(got) == len(want) and set(got) == want


def test_null_text_gives_no_lines(spark):
    df = spark.createDataFrame([(1, None)], "doc_id int, text string")
    assert extract.tag_sections(df).count() == 0


WORDS = ["Python", "power", "BI", "c++", "C#", "trabajo", "en", "equipo", "banca.", "aws", "certified", "node.js", ",", "\n", "sql"]


def word_docs(n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choices(WORDS, k=rng.randint(0, 20))) for _ in range(n)]


def by_hand(text, lexicon):
    tokens = re.findall(r"[^\W_]+(?:\.[^\W_]+)*[+#]*", text.lower())
    runs = {" ".join(tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)}
    return {c: sorted(t for t, k in lexicon.items() if k == c and t in runs) for c in set(lexicon.values())}


def test_terms(spark):
    docs = word_docs(400, 2)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string").repartition(8)
    for r in extract.extract_terms(df).collect():
        assert {c: r[c] for c in set(L.TERMS.values())} == by_hand(docs[r["doc_id"]], L.TERMS)


def test_terms_from_a_table_agree(spark, tmp_path):
    docs = word_docs(400, 3) + ["python"] * 200
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string").repartition(8).write.parquet(path)
    df = spark.read.parquet(path)
    lexicon = spark.createDataFrame(list(L.TERMS.items()), "term string, category string")
    categories = list(dict.fromkeys(L.TERMS.values()))
    table = extract.extract_terms_table(df, lexicon, categories)
    assert sorted(table.collect()) == sorted(extract.extract_terms(df).select(*table.columns).collect())


def test_lexicon_too_large_for_the_plan(spark):
    df = spark.createDataFrame([(1, "t7 y t19999 t20000"), (2, "nada"), (3, None)], "doc_id int, text string")
    found = extract.extract_terms(df, {f"t{i}": "c" for i in range(20_000)}).collect()
    assert {r["doc_id"]: r["c"] for r in found} == {1: ["t19999", "t7"], 2: [], 3: []}


@pytest.mark.parametrize("size", [2, 600, 5_000])
def test_lexicons_of_any_size_give_the_same(spark, size):
    rows = [(1, "Usa SAP y machine-learning"), (1, "sap"), (1, "sap"), (2, None), (None, "Machine learning"), (3, "nada")]
    lexicon = {"SAP": "c", "machine-learning": "c"} | {f"relleno{i}": "c" for i in range(size - 2)}
    found = extract.extract_terms(spark.createDataFrame(rows, "doc_id int, text string"), lexicon)
    got = sorted((str(r["doc_id"]), r["c"]) for r in found.collect())
    assert got == [("1", ["SAP"]), ("1", ["SAP"]), ("1", ["SAP", "machine-learning"]), ("2", []), ("3", []), ("None", ["machine-learning"])]


def test_a_table_shuffles_hits_only(spark):
    words = [f"palabra{i}" for i in range(400)]
    rng = random.Random(4)
    docs = [" ".join(rng.choices(words, k=200)) for _ in range(300)] + ["palabra1 otra", None, ""]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id int, text string").repartition(4)
    lexicon = spark.createDataFrame([("palabra1", "c"), ("palabra2 palabra3", "c"), ("otra", "c")], "term string, category string")
    found = extract.extract_terms_table(df, lexicon, ["c"])
    got = {r["doc_id"]: r["c"] for r in found.collect()}
    spaced = [f" {d or ''} " for d in docs]
    assert got == {i: [t for t in ("otra", "palabra1", "palabra2 palabra3") if f" {t} " in d] for i, d in enumerate(spaced)}
    # Rows behind the filter: hits, and one for each text without any; a filter too small for the lexicon changes no answer.
    runs = df.select(F.explode(F.array(X.words(F.col("text")))).alias("w"))
    may_hold = extract._lexicon_filter(lexicon.select(F.col("term").alias("_run")), 1 << 22)
    passed = runs.select(F.sum(F.size(F.filter("w", may_hold)))).first()[0]
    assert passed == sum(d.split().count("palabra1") + d.split().count("otra") for d in spaced)
    tiny = extract.extract_terms_table(df, lexicon, ["c"], filter_bits=64)
    assert {r["doc_id"]: r["c"] for r in tiny.collect()} == got


def test_long_terms_capitals_and_an_empty_lexicon(spark):
    df = spark.createDataFrame([(1, "Sé administración de bases de  datos y sap"), (2, "")], "doc_id int, text string")
    lexicon = spark.createDataFrame([("administración de bases de datos", "c"), ("SAP", "c")], "term string, category string")
    found = {r["doc_id"]: r["c"] for r in extract.extract_terms_table(df, lexicon, ["c"]).collect()}
    assert found == {1: ["SAP", "administración de bases de datos"], 2: []}
    none = extract.extract_terms_table(df, lexicon.filter("false"), ["c"]).collect()
    assert {r["doc_id"]: r["c"] for r in none} == {1: [], 2: []}


def test_blanks_and_capitals_in_a_list_leave_the_section_open(spark):
    text = "IDIOMAS\n    \nInglés: B2\nAWS GCP\nQuechua: C1\nOFRECEMOS:\nItaliano: A1"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    found = extract.extract_languages(df).first()["languages"]
    assert [i["idioma"] for i in found] == ["Inglés", "Quechua"]


def test_summaries_take_prose_of_their_section_only(spark):
    rows = [
        (1, "\nEva Ruiz\nCalle 1\nPERFIL\nUna línea\n- lista\nDos. Tres. Cuatro."),
        (2, "\nEva Ruiz\nCalle 1\nIDIOMAS\nInglés: B2"),
        (3, "PERFIL\n- solo\n- lista"),
        (4, "Sin títulos. Nada más"),
    ]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: r["summary"] for r in extract.summarize(df, plain=True).collect()}
    assert got == {1: "Una línea Dos. Tres.", 2: "", 3: "solo lista", 4: "Sin títulos. Nada más"}
    # A CV without a profile section has no summary: its lines may be name and address.
    got = {r["doc_id"]: r["summary"] for r in extract.summarize(df).collect()}
    assert got == {1: "Una línea Dos. Tres.", 2: "", 3: "solo lista", 4: ""}


def test_headings_in_any_writing(spark):
    plain = "PERFIL PROFESIONAL\nContadora.\nFORMACIÓN ACADÉMICA\n2012 - 2017: Economía — U\nIDIOMAS\nInglés: B2"
    ways = [
        plain, plain.replace("\n", "\r\n"), plain.replace("\n", "\r"), plain.replace("FORMACIÓN ACADÉMICA", " Formacion  Academica :".replace("  ", " ")),
        plain.replace("PERFIL PROFESIONAL", "Perfil profesional").replace("IDIOMAS", "idiomas:"), plain.replace("Ó", "O\u0301").replace("É", "E\u0301"),
    ]
    df = spark.createDataFrame(list(enumerate(ways)), "doc_id int, text string")
    assert {r["summary"] for r in extract.summarize(df).collect()} == {"Contadora."}
    assert {tuple(r["careers"]) for r in extract.extract_careers(df).collect()} == {("Economía",)}
    assert {tuple(i["idioma"] for i in r["languages"]) for r in extract.extract_languages(df).collect()} == {("Inglés",)}
    assert {r["section"] for r in extract.tag_sections(df.filter("doc_id = 1")).collect()} == {"PERFIL PROFESIONAL", "FORMACIÓN ACADÉMICA", "IDIOMAS"}


JOBS = [
    ("2018 - 2021: A — B", [(2018 * 12, 2021 * 12)]),
    ("- 03/2019–11/2020 C", [(2019 * 12 + 2, 2020 * 12 + 11)]),
    ("Desde setiembre de 2012 hasta Dic. del 2012: D", [(2012 * 12 + 8, 2012 * 12 + 12)]),
    ("2022 a la fecha", [(2022 * 12, 2024 * 12)]),
    ("SEP 2023 - Actualidad: E", [(2023 * 12 + 8, 2024 * 12)]),
    ("2014 - 2014: F", [(2014 * 12, 2015 * 12)]),
    ("nov 2014 - 2014", [(2014 * 12 + 10, 2015 * 12)]),
    ("2019 - 2017: G", []),
    ("2030 - 2031: H", []),
    ("2020 - 2040: I", [(2020 * 12, 2024 * 12)]),
    ("13/2015 - 2016: J", []),
    ("2015 - 00/2016: J", []),
    ("Trabajé de 2010 a 2012", []),
    ("20101 - 2012", []),
    ("2010 - 20125: K", []),
    ("", []),
]


def test_dates_of_jobs(column):
    from datetime import date

    got = column(lambda c: X.job_spans(c, F.lit(date(2024, 1, 31))), [[line] for line, _ in JOBS], "array<string>")
    assert [[(s["start"], s["end"]) for s in r] for r in got] == [want for _, want in JOBS]


def test_covered_months_against_single_months(column):
    rng = random.Random(6)
    spans = [[(a := rng.randint(0, 60), a + rng.randint(1, 20)) for _ in range(rng.randint(0, 8))] for _ in range(300)]
    got = column(X.covered_months, spans, "array<struct<start:int,end:int>>")
    assert got == [len({m for a, b in s for m in range(a, b)}) for s in spans]


def test_experience_of_whole_texts(spark):
    from datetime import date

    rows = [
        (1, "PERFIL\n2000 - 2010: no es empleo\nExperiencia\n2018 - 2021: A — B\n2020 - 2022: C — D\nFORMACIÓN\n2001 - 2006: E — F"),
        (1, "EXPERIENCIA\r\n2023 - hoy: A"), (2, None), (3, ""), (None, "sin secciones 2018 - 2021"),
        (4, "EXPERIENCIA\n" + "2001 - 2002: A — B\n2003 - 2004: C — D\n" * 3_000),
    ]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id int, text string, years int")
    got = [(r["doc_id"], r["jobs"], r["months"], r["years"]) for r in extract.experience_from_jobs(df, F.lit(date(2024, 1, 1))).collect()]
    assert sorted(got, key=str) == [(1, 1, 12, 1.0), (1, 2, 48, 4.0), (2, 0, 0, 0.0), (3, 0, 0, 0.0), (4, 6000, 24, 2.0), (None, 0, 0, 0.0)]


def test_years(column):
    values = ["4 años y 12+  AÑOS", "sin", "", "1" * 400 + " años", "07 años", None, "2.5 años", "1,5 años", "5\u00a0años", "5 an\u0303os", "30 años de edad", "tengo 30 años", "Tengo 5 años de experiencia",
              "empresa con 40 años en el mercado. Pedimos 3 años", "10 (diez) años", "Edad: 33 años", "firma con 25 años; se piden 2 años"]
    want = [12.0, None, None, float("inf"), 7.0, None, 2.5, 1.5, 5.0, 5.0, None, None, 5.0, 3.0, 10.0, None, 2.0]
    assert column(X.years_required, values) == want


def test_levels(column):
    values = [0.0, 1.9, 2.0, 4.9, 5.0, 10.0, None]
    assert column(X.infer_level, values, "double") == [
        "junior", "junior", "semi-senior", "semi-senior", "senior", "lead", None,
    ]


def test_dated_titles(column):
    lines = [
        "2020 - Actualidad: Jefa de Obra — Sur SAC", "2019-2020:Asistente  —  Norte", "2018 - 2019: Sin empresa",
        "- 2020 - 2021: A — B", "2020 - 2021: A - B — C — D", "2020 - 2021: " + "x " * 20_000,
    ]
    assert column(X.dated_titles, [lines], "array<string>") == [["Jefa de Obra", "Asistente", "A - B"]]


def test_language_pairs(column):
    lines = ["Italiano: Nativo | Alemán: C1 (curso 2021)", "- Portugués :  muy  básico ", "nada", "a: b: c", "x" + " " * 50_000 + "y"]
    got = column(X.language_pairs, [lines], "array<string>")[0]
    assert [(i["idioma"], i["nivel"]) for i in got] == [
        ("Italiano", "Nativo"), ("Alemán", "C1"), ("Portugués", "muy  básico"),
    ]


def test_language_mentions(column):
    text = "Inglés B2 y FRANCÉS: avanzado, preinglés C1, español B25, quechua nativo"
    got = column(X.language_mentions, [text])[0]
    assert [(i["idioma"], i["nivel"]) for i in got] == [("Inglés", "B2"), ("FRANCÉS", "avanzado"), ("quechua", "nativo")]


def test_bullets_and_title(column):
    assert column(X.bullets, [["- uno ", "dos", " • tres", "-", "-  "]], "array<string>") == [["uno", "tres"]]
    assert column(X.labelled_title, ["x\nCARGO:  Jefe de Área  \n", "PUESTO:\nx", ""]) == ["Jefe de Área", "", ""]


def test_education(spark):
    rows = [(1, "Bachiller y Maestría"), (2, "nada"), (3, "técnico, doctorado")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: (r["highest"], r["lowest"]) for r in extract.extract_education(df).collect()}
    assert got == {1: ("magister", "bachiller"), 2: (None, None), 3: ("doctor", "tecnico")}


def test_section_lines_of_repeated_headings(spark):
    df = spark.createDataFrame([(1, "IDIOMAS\na\nPERFIL\nb\nIDIOMAS:\nc")], "doc_id int, text string")
    cut = extract.with_sections(df)
    lines = cut.select(X.section_lines(F.col("sections"), ("IDIOMAS",)).alias("l")).first()["l"]
    assert lines == ["a", "c"]
