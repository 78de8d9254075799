"""Names and other private lines: masked in texts, kept out of records."""

import json
import re

from pyspark.sql import functions as F

from legajo.functions import extract as X
from legajo.functions import names as N
from legajo.functions import redact as R
from legajo.operators.anonymize import anonymize
from legajo.operators.records import build_cv_records, build_jd_records
from legajo.operators.segment import learn
from legajo.plans import corpora as C

TAG = "[NOMBRE_REDACTADO]"


def words_of(text):
    return N.name_words(text, R.first_line(R.without_blank_lead(text)))


def masked(column, text):
    return column(lambda c: N.mask_mentions(c, words_of(c)), [text])[0]


def test_mentions_in_any_writing(column):
    name = "María Ñahui de la Cruz\n"
    cases = {
        "La Sra. Maria, o MARÍA Ñahui De La Cruz, vive": f"La Sra. {TAG}, o {TAG}, vive",
        "Nahui y Cruz": f"{TAG}",
        "una cruz, la maría, Marías, xMaría, María2": "una cruz, la maría, Marías, xMaría, María2",
        "De la Cruz Ñahui María": f"De la {TAG}",
        "": "",
    }
    for text, want in cases.items():
        assert masked(column, name + text) == f"{TAG}\n{want}", text


def test_where_names_are_given(column):
    words = lambda t: column(words_of, [t])[0]
    assert words("\n \nJuan Carlos Pérez\nx") == ["JUAN", "CARLOS", "PEREZ"]
    assert words("Hoja de vida\nApellidos y nombres : Soto Ruiz, Ana | DNI\nNOMBRE: Eva") == ["SOTO", "RUIZ", "ANA", "EVA"]
    assert words("PERFIL PROFESIONAL\nAna Soto") == [] and words("Curriculum Vitae\nx") == [] and words("uno dos") == []
    assert words("") == [] and words("Sí Ya") == [] and words(None) in ([], None)


def test_option_is_off_by_default(spark):
    text = "Eva Ruiz Soto\nRuiz lidera"
    df = spark.createDataFrame([(text,), (None,), ("",), ("a b c d e f g h",)], "text string")
    assert [r[0] for r in anonymize(df).select("text_anon").collect()] == [f"{TAG}\nRuiz lidera", None, TAG, "a b c d e f g h"]
    assert [r[0] for r in anonymize(df, names=True).select("text_anon").collect()] == [f"{TAG}\n{TAG} lidera", None, TAG, "a b c d e f g h"]
    assert anonymize(df, names=True).columns == anonymize(df).columns


def test_private_lines(column):
    private = [
        "Juan Pérez Quispe", "JUAN PÉREZ", "Pérez, Juan C.", "María de la Cruz", "Av. Arequipa 123, Lima", "Jr. Puno 4", "Calle Sol", "Dirección: Lima",
        "Nombre: eva", "Apellidos y nombres: x", "x@y.pe", "[DNI_REDACTADO] x", "llamar 123456", "  Urb. Los Pinos Mz. A",
    ]
    public = ["Contadora con ganas.", "Una línea", "Lidera equipos de Lima y Puno", "Calleja es un barrio", "Caminos", "Vive cerca.", "Dos. Tres."]
    assert column(X.private, private) == [True] * len(private)
    assert column(X.private, public) == [False] * len(public)


def test_nothing_private_in_any_record(spark):
    docs = C.free_cv_corpus(spark, "/root/testdata/sf0.01")
    rows = build_cv_records(docs, "s", as_of=F.lit(C.AS_OF).cast("date")).select(F.to_json("record").alias("r"), "errors").collect()
    assert sum(not r["errors"] for r in rows) > 0.8 * len(rows)
    secret = re.compile(r"quispe|mamani|rosa\b|paredes|luis|alberto|d[ií]az|\bana\b|mar[ií]a|soto|cruz|[ñn]ahui|olmos|puno\b|cusco|@|correo", re.I)
    for r in rows:
        assert not secret.search(r["r"] or ""), r["r"]
        if not r["errors"]:
            assert json.loads(r["r"])["resumen_perfil"]


def test_the_case_that_failed_before(spark):
    text = "\nHoja\nPERFIL\nJuan Pérez Quispe\nAv. Arequipa 123, Lima\nContadora con 4 años. Ordenada.\nEDUCACION\nBachiller"
    df = spark.createDataFrame([(1, text), (2, text.replace("\n", "\r\n"))], "doc_id int, text string")
    got = build_cv_records(df, "s").select("record.resumen_perfil", "record.anos_experiencia", "errors").collect()
    assert [tuple(r) for r in got] == [("Contadora con 4 años. Ordenada.", 4.0, [])] * 2


def test_nor_with_headings_that_no_list_knows(spark):
    sf = "/root/testdata/sf0.001"
    docs, costs = C.strange_cv_corpus(spark, sf), learn(C.free_cv_corpus(spark, sf))
    as_of = F.lit(C.AS_OF).cast("date")
    rows = build_cv_records(docs, "s", as_of=as_of, costs=costs).select(F.to_json("record").alias("r"), "errors").collect()
    assert sum(not r["errors"] for r in rows) > 0.8 * len(rows)
    assert not any(re.search(r"quispe|paredes|d[ií]az|mar[ií]a|soto|cruz|[ñn]ahui|olmos|puno\b|cusco|@", r["r"] or "", re.I) for r in rows)


def test_years_of_job_descriptions_come_from_what_is_required(spark):
    text = "Somos un equipo con 12 años de trabajo\nRequisitos:\n- 3 años con Python\nFunciones\nDiseñar."
    rows = [(1, "t", text), (2, "t", text.replace("- 3 años", "- algo")), (3, "t", "Funciones\nDiseñar.")]
    built = build_jd_records(spark.createDataFrame(rows, "doc_id int, title string, text string"), "s")
    assert {r["doc_id"]: r["record"]["anos_experiencia_min"] for r in built.collect()} == {1: 3.0, 2: 12.0, 3: 0.0}
