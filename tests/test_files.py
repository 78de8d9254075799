"""Files: names, readers, decoding, sinks, folders to records, arriving files."""

import io
import json
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from legajo.functions.contract import CV_RULES, JD_RULES, record_schema
from legajo.operators.validate import split_quarantine, validate_cv
from legajo.plans import folder as P
from legajo.sources import files, office, sinks
from legajo.streaming.arrivals import cv_record_stream

NAMES = [
    "a.txt", "a.b.PDF", ".profile", "a.", "a", "a b%20ñ.DocX", "..x", "a.tar.gz", "x.doc", "-_.md", "a..b",
]

CV = """
Ana María Ríos
DNI: 40123456 | Celular: +51 912345678 | ana.rios@correo.pe

PERFIL PROFESIONAL
Analista con 6 años de experiencia en Python. Trabajó en banca y retail.
Aprende rápido. Le gusta el liderazgo.

EXPERIENCIA LABORAL
2020 - Actualidad: Analista de Riesgos — Banco Andino
- Tableros en Power BI
2017 - 2020: Practicante — Caja Sur

EDUCACIÓN
2010 - 2015: Economía — Universidad del Norte
Bachiller, luego maestría

IDIOMAS
Español: Nativo | Inglés: B2 (examen 2019)
"""

JD = """
PUESTO: Ingeniera de Datos
Empresa: Molinos del Sur

REQUISITOS OBLIGATORIOS:
- 3+ años con Spark y SQL
- Bachiller o magíster
- Inglés B1 como mínimo

REQUISITOS DESEABLES:
- Kafka o Power BI
"""


def docx(paragraphs):
    """A minimal DOCX; a table's text must not show up."""
    ns = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    runs = "".join(f"<w:p>{p}</w:p>" for p in paragraphs)
    table = "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>tabla</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
    xml = f'<?xml version="1.0" encoding="UTF-8"?><w:document {ns}><w:body>{runs}{table}</w:body></w:document>'
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as package:
        package.writestr("word/document.xml", xml)
    return data.getvalue()


def run(text):
    return f'<w:r><w:t xml:space="preserve">{text}</w:t></w:r>'


def test_name_parts_as_pathlib_gives_them(spark):
    df = spark.createDataFrame([(f"file:/d.x/{n}",) for n in NAMES], "path string")
    for r in files.with_name_parts(df).collect():
        path = Path(r["name"])
        assert (r["stem"], r["suffix"]) == (path.stem, path.suffix)


def test_routes(spark):
    pairs = [(".pdf", "pdf"), (".PDF", "pdf"), (".docx", "docx"), (".Doc", "docx"), (".txt", "text"), ("", "text"), (None, "text")]
    df = spark.createDataFrame(pairs, "suffix string, want string")
    assert all(r["kind"] == r["want"] for r in files.route_by_suffix(df).collect())


def test_scan_and_decode(spark, tmp_path):
    contents = {
        "crlf.txt": b"a\r\nb\rc\n", "bom.TXT": b"\xef\xbb\xbfhola", "mal.txt": b"a\xff", "vacio.txt": b"",
        "sub/ñandú.md": "año".encode(), "a%20b": b"x",
    }
    for name, data in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    listed = files.list_folder(spark, str(tmp_path))
    assert {r["length"] for r in listed.collect()} == {len(c) for c in contents.values()}
    rows = files.decode_text(files.scan_documents(spark, str(tmp_path), manifest=listed)).collect()
    got = {r["name"]: (r["text"], r["decode_ok"]) for r in rows}
    assert got == {
        "crlf.txt": ("a\nb\nc\n", True), "bom.TXT": ("﻿hola", True), "mal.txt": (None, False),
        "vacio.txt": ("", True), "ñandú.md": ("año", True), "a%20b": ("x", True),
    }
    only = files.scan_documents(spark, str(tmp_path), "*.[tT][xX][tT]")
    assert {r["name"] for r in only.collect()} == {"crlf.txt", "bom.TXT", "mal.txt"}


TEXTS = ["", "uno\ndos\n", "\r\n\x1e\n\x1e.\x1e", "ñ\ttab", "\n\n", "a\x1e", "fin\n"]


@pytest.mark.parametrize("file_each", [False, True])
def test_texts_come_back(spark, tmp_path, file_each):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string").repartition(3)
    path = str(tmp_path / "out")
    sinks.write_documents_text(df, path, file_each=file_each)
    back = sinks.read_documents_text(spark, path, file_each=file_each).collect()
    assert {int(r["doc_id"]): r["text"] for r in back} == dict(enumerate(TEXTS))


def test_records_come_back_and_keep_letters(spark, tmp_path):
    body = json.dumps({
        "candidato_id": "x", "nivel_experiencia": "lead", "anos_experiencia": 4, "skills_tecnicos": ["ñ"],
        "skills_blandos": [], "industrias": [], "cargos_anteriores": [], "nivel_educacion": "doctor",
        "carreras": [], "idiomas": [{"idioma": "inglés", "nivel": "B2"}], "resumen_perfil": "año",
    })
    df = spark.createDataFrame([(body,)], "body string")
    good, _ = split_quarantine(validate_cv(df))
    sinks.write_records_json(good, str(tmp_path / "r"))
    written = "".join(p.read_text("utf-8") for p in (tmp_path / "r").glob("*.json"))
    assert "inglés" in written and '"certificaciones":[]' in written
    back = sinks.read_records_json(spark, str(tmp_path / "r"), record_schema(CV_RULES))
    assert back.collect() == good.select("record.*").collect()


def test_docx_paragraphs(spark):
    content = docx([
        run("uno") + run(" dos"), "", run(" "), "<w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/><w:t>c</w:t><w:br w:type=\"page\"/></w:r>",
        f"<w:hyperlink>{run('enlace')}</w:hyperlink>", "<w:ins>" + run("oculto") + "</w:ins>",
    ])
    rows = [(1, bytearray(content)), (2, bytearray(b"no zip")), (3, None)]
    df = spark.createDataFrame(rows, "i int, content binary")
    out = df.select("i", office.docx_paragraphs(F.col("content")).alias("p"))
    got = {r["i"]: (r["p"], r["t"]) for r in out.select("i", "p", office.join_paragraphs(F.col("p")).alias("t")).collect()}
    assert got[1] == (["uno dos", "", " ", "a\tb\nc", "enlace", ""], "uno dos\na\tb\nc\nenlace")
    assert got[2] == (None, None) and got[3] == (None, None)


STUB = """
class open:
    def __init__(self, stream, filetype):
        if not stream.startswith(b"%PDF"):
            raise ValueError("no PDF")
        self.pages = stream.decode().split("|")
    def __enter__(self):
        return [type("Page", (), {"get_text": lambda self, kind, t=t: t})() for t in self.pages]
    def __exit__(self, *error):
        return False
"""


def test_pdf_pages_with_a_stand_in_reader(spark, tmp_path, monkeypatch):
    (tmp_path / "pymupdf.py").write_text(STUB)
    monkeypatch.syspath_prepend(str(tmp_path))
    spark.sparkContext.addPyFile(str(tmp_path / "pymupdf.py"))
    assert office.has_pdf_reader()
    rows = [(1, bytearray(b"%PDF a|b| ")), (2, bytearray(b"otro")), (3, None)]
    df = spark.createDataFrame(rows, "i int, content binary")
    pages = df.select("i", office.pdf_pages(F.col("content")).alias("p"))
    got = {r["i"]: r["t"] for r in pages.select("i", office.join_pages(F.col("p")).alias("t")).collect()}
    assert got == {1: "%PDF a\nb\n ", 2: None, 3: None}


def cv_folder(tmp_path):
    cvs = tmp_path / "cvs"
    cvs.mkdir()
    (cvs / "ana.txt").write_text(CV, "utf-8")
    (cvs / "mal.txt").write_bytes(b"\xff\xfe")
    (cvs / "vacio.txt").write_bytes(b"")
    (cvs / "luis.docx").write_bytes(docx([run(line) for line in CV.split("\n")]))
    (cvs / "roto.DOC").write_bytes(b"roto")
    (cvs / "x.pdf").write_bytes(b"roto")
    return str(cvs)


WANT = dict(
    nivel_experiencia="senior", anos_experiencia=6.0, skills_tecnicos=["power bi", "python"],
    skills_blandos=["liderazgo"], industrias=["banca", "retail"],
    cargos_anteriores=["Analista de Riesgos", "Practicante"], nivel_educacion="magister",
    carreras=["Economía"], certificaciones=[],
)


def test_cv_folder_to_records(spark, tmp_path):
    where = cv_folder(tmp_path)
    built = P.cv_records(spark, where, "sal", files.list_folder(spark, where)).collect()
    by_name = {r["path"].rsplit("/", 1)[1]: r for r in built}
    assert {n: r["errors"] for n, r in by_name.items()} == {
        "ana.txt": [], "luis.docx": [], "mal.txt": ["decode"], "roto.DOC": ["docx"], "x.pdf": ["pdf"],
        "vacio.txt": ["text", "nivel_educacion", "resumen_perfil"],
    }
    ana = by_name["ana.txt"]["record"].asDict(recursive=True)
    assert {k: ana[k] for k in WANT} == WANT
    assert ana["idiomas"] == [{"idioma": "Español", "nivel": "Nativo"}, {"idioma": "Inglés", "nivel": "B2"}]
    assert ana["resumen_perfil"] == (
        "Analista con 6 años de experiencia en Python. Trabajó en banca y retail. Aprende rápido."
    )
    assert by_name["luis.docx"]["record"]["cargos_anteriores"] == WANT["cargos_anteriores"]


def test_jd_folder_to_records(spark, tmp_path):
    jds = tmp_path / "jds"
    jds.mkdir()
    (jds / "uno.txt").write_text(JD, "utf-8")
    (jds / "jefa-de_ventas.txt").write_text("Buscamos jefa. Sin más.\n", "utf-8")
    rows = P.jd_records(spark, str(jds), "sal").collect()
    by_title = {r["record"]["titulo_puesto"]: r["record"].asDict(recursive=True) for r in rows}
    assert all(r["errors"] == [] for r in rows)
    assert set(by_title) == {"Ingeniera de Datos", "Jefa De Ventas"}
    one = by_title["Ingeniera de Datos"]
    assert one["skills_requeridos"] == ["spark", "sql"] and one["skills_deseables"] == ["kafka", "power bi"]
    assert one["anos_experiencia_min"] == 3.0 and one["nivel_requerido"] == "semi-senior"
    assert one["nivel_educacion_minimo"] == "bachiller"
    assert one["idiomas_requeridos"] == [{"idioma": "Inglés", "nivel": "B1"}]
    assert by_title["Jefa De Ventas"]["nivel_educacion_minimo"] == "no especificado"
    assert record_schema(JD_RULES).startswith("jd_id string, titulo_puesto string")


def test_arriving_files_give_the_batch_result(spark, tmp_path):
    where = cv_folder(tmp_path)
    out = str(tmp_path / "out")
    for later in (None, "eva.txt"):
        if later:
            (Path(where) / later).write_text(CV.replace("6 años", "1 años"), "utf-8")
        writer = cv_record_stream(spark, where, "sal", str(tmp_path / "state"))
        writer.format("parquet").trigger(availableNow=True).start(out).awaitTermination()
    batch = P.cv_records(spark, where, "sal")
    stream = spark.read.parquet(out)
    assert sorted(map(str, stream.collect())) == sorted(map(str, batch.select(*stream.columns).collect()))
    assert stream.filter(F.col("record.nivel_experiencia") == "junior").count() >= 1


def test_folders_with_any_name_are_listed_at_every_depth(spark, tmp_path):
    want = {}
    for name in ("con espacio", "año", "a%20b", "a#b", "x/y/z"):
        place = tmp_path / name
        place.mkdir(parents=True)
        (place / "f 1.txt").write_text(name, "utf-8")
        want[f"file:{place}/f 1.txt"] = name
    (tmp_path / "vacía").mkdir()
    listed = files.list_folder(spark, str(tmp_path))
    assert {r["path"]: r["length"] for r in listed.collect()} == {p: len(t.encode()) for p, t in want.items()}
    read = files.decode_text(files.read_files(listed)).collect()
    assert {r["path"]: r["text"] for r in read} == want
    one = files.list_folder(spark, [str(tmp_path / "a#b"), f"file:{tmp_path}/año"])
    assert one.count() == 2


def test_a_null_text_stays_null(spark, tmp_path):
    rows = [("1", None), ("2", ""), ("3", "a\n\x1eb")]
    where = str(tmp_path / "texts")
    sinks.write_documents_text(spark.createDataFrame(rows, "doc_id string, text string"), where)
    assert sorted((r["doc_id"], r["text"]) for r in sinks.read_documents_text(spark, where).collect()) == rows
