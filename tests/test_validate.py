"""Reply checking: the traps of numbers, lists and nested items."""

import json

import pytest
from pyspark.sql import functions as F

from legajo.functions.contract import CV_RULES, JD_RULES
from legajo.operators.requests import json_schema
from legajo.operators.validate import parse_response, split_quarantine, validate_response

CV = {
    "candidato_id": "x", "nivel_experiencia": "lead", "anos_experiencia": 4, "skills_tecnicos": ["a"],
    "skills_blandos": [], "industrias": [], "cargos_anteriores": [], "nivel_educacion": "doctor",
    "carreras": [], "certificaciones": ["c"], "idiomas": [{"idioma": "i", "nivel": "n"}], "resumen_perfil": "r",
}
JD = {
    "jd_id": "x", "titulo_puesto": "t", "nivel_requerido": "junior", "anos_experiencia_min": 1,
    "skills_requeridos": [], "skills_deseables": [], "industria_preferida": [],
    "nivel_educacion_minimo": "cualquiera", "idiomas_requeridos": [], "descripcion_rol": "d",
}
GONE = object()


def changed(base, **fields):
    record = {**base, **fields}
    return json.dumps({k: v for k, v in record.items() if v is not GONE}, ensure_ascii=False)


def check(spark, bodies, rules):
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string").repartition(4)
    rows = validate_response(df, rules).orderBy("i").collect()
    return [r["errors"] for r in rows], [r["record"] for r in rows]


CV_CASES = [
    ({}, []),
    ({"extra": {"a": 1}}, []),
    ({"certificaciones": GONE}, []),
    ({"certificaciones": None}, ["certificaciones"]),
    ({"candidato_id": 7}, ["candidato_id"]),
    ({"candidato_id": None}, ["candidato_id"]),
    ({"candidato_id": ""}, []),
    ({"nivel_experiencia": "Lead"}, ["nivel_experiencia"]),
    ({"nivel_educacion": GONE}, ["nivel_educacion"]),
    ({"anos_experiencia": -0.5}, ["anos_experiencia"]),
    ({"anos_experiencia": [1]}, ["anos_experiencia"]),
    ({"anos_experiencia": None}, ["anos_experiencia"]),
    ({"skills_tecnicos": [None]}, ["skills_tecnicos"]),
    ({"skills_tecnicos": ["a", None]}, ["skills_tecnicos"]),
    ({"skills_tecnicos": ["a", 1]}, ["skills_tecnicos"]),
    ({"skills_tecnicos": [1]}, ["skills_tecnicos"]),
    ({"skills_tecnicos": "a"}, ["skills_tecnicos"]),
    ({"skills_tecnicos": None, "carreras": GONE}, ["skills_tecnicos", "carreras"]),
    ({"idiomas": []}, []),
    ({"idiomas": None}, ["idiomas"]),
    ({"idiomas": {"idioma": "i", "nivel": "n"}}, ["idiomas"]),
    ({"idiomas": [{"idioma": "i"}]}, ["idiomas"]),
    ({"idiomas": [{"idioma": "i", "nivel": 2}]}, ["idiomas"]),
    ({"idiomas": [{"idioma": "i", "nivel": "n", "z": 1}]}, []),
    ({"idiomas": ["i"]}, ["idiomas"]),
    ({"idiomas": [{"idioma": "i", "nivel": "n"}, None]}, ["idiomas"]),
]


def test_cv_rules(spark):
    errors, records = check(spark, [changed(CV, **c) for c, _ in CV_CASES], CV_RULES)
    assert [(c, e) for (c, _), e in zip(CV_CASES, errors)] == [(c, e) for c, e in CV_CASES]
    assert all((r is None) == bool(e) for r, e in zip(records, errors))
    assert records[0]["anos_experiencia"] == 4.0 and records[2]["certificaciones"] == []


# What a number may look like, and its value; None fails.
NUMBERS = [
    (3, 3.0), (2.5, 2.5), (True, 1.0), (False, 0.0), ("4.5", 4.5), (" 7 ", 7.0), ("1_000", 1000.0),
    ("1__0", None), ("_1", None), ("2.5d", None), ("0x10", None), ("", None), ("dos", None), ("1e2", 100.0),
    (".5", 0.5), ("5.", 5.0), ("+3", 3.0), ("inf", float("inf")), ("Infinity", float("inf")),
    ("1,5", None), (12345678901234567890, 1.2345678901234567e19), ("1e400", float("inf")),
]


@pytest.mark.parametrize("rules, base, name", [(CV_RULES, CV, "anos_experiencia"), (JD_RULES, JD, "anos_experiencia_min")])
def test_numbers(spark, rules, base, name):
    errors, records = check(spark, [changed(base, **{name: n}) for n, _ in NUMBERS], rules)
    got = [(n, None if e else r[name]) for (n, _), e, r in zip(NUMBERS, errors, records)]
    assert got == NUMBERS
    assert all(e in ([], [name]) for e in errors)


def test_not_a_number_passes_only_where_no_bound_is_set(spark):
    for sign in ("nan", "-nan", "+NaN"):
        assert check(spark, [changed(CV, anos_experiencia=sign)], CV_RULES)[0] == [["anos_experiencia"]]
        errors, records = check(spark, [changed(JD, anos_experiencia_min=sign)], JD_RULES)
        assert errors == [[]] and records[0]["anos_experiencia_min"] != records[0]["anos_experiencia_min"]
    assert check(spark, [changed(JD, anos_experiencia_min=-3)], JD_RULES)[0] == [[]]


def test_broken_json(spark):
    bodies = ["", "no", "[1]", '"a"', "7", "null", "{", '{"a":1,"a":2}', '{"a":NaN}', None]
    assert check(spark, bodies, CV_RULES)[0] == [["json"]] * len(bodies)


def test_repeated_keys_by_setting(spark):
    body = changed(CV)[:-1] + ', "candidato_id": "y"}'
    assert check(spark, [body], CV_RULES)[0] == [["json"]]
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    try:
        errors, records = check(spark, [body], CV_RULES)
    finally:
        spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    assert errors == [[]] and records[0]["candidato_id"] == "y"


def test_parse_keeps_what_fits(spark):
    bodies = [changed(CV, anos_experiencia="dos"), "no"]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string")
    good, bad = parse_response(df, CV_RULES).orderBy("i").collect()
    assert good["is_json"] and good["record"]["anos_experiencia"] is None
    assert good["record"]["skills_tecnicos"] == ["a"] and good["record"]["idiomas"][0]["nivel"] == "n"
    assert not bad["is_json"] and bad["record"] is None


@pytest.mark.parametrize("stored", [False, True])
def test_split_is_complete(spark, tmp_path, stored):
    bodies = [changed(CV, **c) for c, _ in CV_CASES] + ["no"]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string").repartition(4)
    checked = validate_response(df, CV_RULES)
    good, bad = split_quarantine(checked, str(tmp_path / "sides") if stored else None)
    want = {i for i, (_, e) in enumerate(CV_CASES) if not e}
    assert {r["i"] for r in good.collect()} == want
    rest = bad.collect()
    assert {r["i"] for r in rest} == set(range(len(bodies))) - want
    assert all(r["body"] and r["errors"] for r in rest)


def test_one_parse_per_reply(spark):
    df = spark.range(5).select(F.col("id").cast("string").alias("body"))
    good, _ = split_quarantine(validate_response(df, CV_RULES))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_json_schema():
    schema = json.loads(json_schema(CV_RULES))
    assert "certificaciones" not in schema["required"] and len(schema["properties"]) == 12
    assert schema["properties"]["anos_experiencia"] == {"type": "number", "minimum": 0}
    assert json.loads(json_schema(JD_RULES))["properties"]["idiomas_requeridos"]["items"]["required"] == ["idioma", "nivel"]


def test_values_of_another_type_come_out_null(spark):
    from legajo.functions.contract import CV_RULES
    from legajo.operators.validate import parse_response

    body = '{"candidato_id":7,"skills_tecnicos":["a",7],"resumen_perfil":{"a":1},"idiomas":[{"idioma":3,"nivel":"B1"}],"industrias":["x"]}'
    record = parse_response(spark.createDataFrame([(body,)], "body string"), CV_RULES).first()["record"]
    assert (record["candidato_id"], record["skills_tecnicos"], record["resumen_perfil"]) == (None, None, None)
    assert record["industrias"] == ["x"] and [tuple(i) for i in record["idiomas"]] == [(None, "B1")]
