"""CVs, job descriptions, replies and attempt logs derived from the driver's tables.

Each recipe is one row-wise SQL expression over a table's columns, written so
that Spark and DuckDB read it alike; corpora grow with their tables. Wording,
names and numbers are made up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _case(key: str, modulus: int, *values: str) -> str:
    """``values[i]`` where ``key % modulus`` is i, the last one otherwise."""
    arms = " ".join(f"WHEN {key} % {modulus} = {i} THEN {v}" for i, v in enumerate(values[:-1]))
    return f"CASE {arms} ELSE {values[-1]} END"


def _lines(*parts: str) -> str:
    return " || chr(10) || ".join(f"({p})" for p in parts)


K = "c_custkey"

CV_TEXT = _lines(
    _case(
        K, 4, "''", "'Postulante ' || c_mktsegment",
        "'Hoja de vida del postulante número ' || " + _s(K),
        "'Resumen profesional de la persona con código ' || " + _s(K),
    ),
    "'DNI: ' || " + _s(f"10000000 + ({K} * 7919) % 90000000")
    + " || ' | RUC: ' || " + _s(f"20000000000 + {K} * 104729")
    + " || ' | Celular: ' || " + _case(K, 3, "'+51 '", "'+51'", "''")
    + " || " + _s(f"900000000 + ({K} * 15485863) % 99999999")
    + " || ' | Fijo: ' || " + _s(f"1000000 + ({K} * 31) % 9000000")
    + f" || ' | Correo: josé.' || {_s(K)} || '@mi-correo' || " + _case(K, 2, "'.com'", "'.red-sur.pe'")
    + " || CASE WHEN " + K + " % 25 = 0 THEN ' o ana@uno.pe' ELSE '' END",
    "'Av. Las Flores 12, Arequipa'",
    "''",
    _case(K, 9, *["'PERFIL PROFESIONAL'"] * 8, "'Sobre mi trabajo'"),
    f"'Analista de datos con ' || {_s(f'{K} % 15')} || CASE WHEN {K} % 8 = 3 THEN ',5' ELSE '' END || ' años de experiencia en Python y SQL. "
    "Proyectos para ' || " + _case(K, 3, "'banca'", "'retail'", "'minería'")
    + " || '. ' || " + _case(K, 2, "'Liderazgo y trabajo en equipo'", "'Empatía'")
    + " || '. Disponible para viajar.'",
    "''",
    "'EXPERIENCIA LABORAL'",
    "'2021 - Actualidad: ' || " + _case(K, 2, "'Analista de Datos'", "'Ingeniera de Datos'")
    + " || ' — Empresa ' || c_mktsegment",
    "'- Reportes y tableros para ventas'",
    _case(K, 3, "'2018 - 2021: Asistente de Sistemas — Taller Sur'", "'- Soporte a usuarios'"),
    "''",
    "'EDUCACIÓN'",
    "'2012 - 2017: ' || " + _case(K, 2, "'Estadística'", "'Economía'")
    + " || ' — Universidad del Valle'",
    _case(
        K, 5, "'Grado de bachiller'", "'Bachiller y licenciado'", "'Maestría en datos'",
        "'Técnico en computación'", "'Cursos libres'",
    ),
    "''",
    "'HABILIDADES TÉCNICAS'",
    _case(K, 2, "'Python, Django, PostgreSQL, Docker, Git'", "'Java, Spark, Kafka, Power BI, C++'"),
    _case(K, 4, "'Certificaciones: PMP, Scrum Master'", "'AWS Certified (asociado)'", "''"),
    "''",
    "'IDIOMAS'",
    "'Español: Nativo | Inglés: ' || " + _case(K, 2, "'B2 (examen 2022)'", "'C1'"),
)

# CVs as people write them: headings in any writing, lines ended as elsewhere, names and addresses in the text, jobs that overlap.
_NAME = _case(K, 4, "'Rosa Quispe Mamani'", "'LUIS ALBERTO PAREDES DÍAZ'", "'Nombre: Ana María Soto de la Cruz'", "'María Ñahui'")
_MENTION = _case(K, 4, "'La contadora Quispe'", "'Paredes Diaz, Luis,'", "'SOTO DE LA CRUZ'", "'Maria'")
_FREE_CV = _lines(
    _NAME,
    "'DNI: ' || " + _s(f"20000000 + ({K} * 6151) % 70000000") + " || ' | p.' || " + _s(K) + " || '@correo.pe'",
    "'Av. Los Olmos ' || " + _s(f"{K} % 900") + " || ', Cusco'",
    "''",
    "'PERFIL PROFESIONAL'",
    _case(K, 3, "'Ana Soto Quispe'", "'Jr. Puno ' || " + _s(f"{K} % 90") + " || ', Puno'", "'Vive cerca.'"),
    f"'Especialista con ' || {_s(f'{K} % 14')} || ' años de experiencia en ' || " + _case(K, 5, "'Java y Spark'", "'Python y SQL'") + " || '. ' || " + _MENTION
    + " || ' coordina equipos de ' || " + _case(K, 3, "'banca'", "'retail'", "'minería'") + " || ' con ' || "
    + _case(K, 2, "'liderazgo'", "'empatía'") + " || '. Tengo 41 años. Otra frase.'",
    "''",
    "'EXPERIENCIA LABORAL'",
    f"{_s(f'2008 + {K} % 7')} || ' - ' || {_s(f'2012 + {K} % 5')} || ': Analista — Taller Norte'",
    "'- Informes para ventas'",
    f"'marzo 2016 – 0' || {_s(f'1 + {K} % 9')} || '/2019: Jefa de Área — Sur SAC'",
    _case(K, 3, "'2020 - Actualidad: Gerente de Datos — Andes'", "'Ago. de 2021 a la fecha: Consultora'", "'- Soporte a usuarios'"),
    _case(K, 5, "'2019 - 2017: Al revés — Nada'", "'2014 - 2014: Asistente — Uno'", "'13/2015 - 2016: Sin mes'", "'2018-2030: Docente — Dos'", "''"),
    "'EDUCACIÓN'",
    "'2003 - 2008: ' || " + _case(K, 3, "'Contabilidad'", "'Economía'") + " || ' — Universidad del Valle'",
    _case(K, 6, "'Grado de bachiller'", "'Título de licenciada'", "'Maestría en datos'", "'Técnico en redes'", "'Bachiller'", "'Cursos libres'"),
    _case(K, 4, "'- Certificada en PMP'", "'- Examen de ITIL y Scrum Master'", "''"),
    "'IDIOMAS'",
    "'Español: Nativo | Inglés: ' || " + _case(K, 2, "'B2'", "'C1'"),
)
_HEADS = ("PERFIL PROFESIONAL", "EXPERIENCIA LABORAL", "EDUCACIÓN", "IDIOMAS")


def _with_heads(*heads: str) -> str:
    out = "text"
    for old, new in zip(_HEADS, heads):
        out = f"replace({out}, '{old}', '{new}')"
    return out


def _crlf(text: str) -> str:
    return f"replace({text}, chr(10), chr(13) || chr(10))"


#: Over (doc_id, text): the same CVs in five writings.
WRITINGS = _case(
    "doc_id", 5,
    _with_heads("Perfil profesional", "Experiencia laboral", "Educación", "Idiomas"),
    _with_heads("PERFIL", "EXPERIENCIA LABORAL :", "EDUCACION", "IDIOMAS:"),
    _crlf("text"),
    _crlf(_with_heads("Resumen:", "Experiencia Profesional", " Formacion Academica: ", "idiomas")),
    "text",
)
#: The same with headings that no list knows for one CV in three.
STRANGE_HEADS = (
    f"CASE WHEN doc_id % 3 = 0 THEN {_with_heads('Sobre mí', 'Trayectoria', 'Mis estudios', 'Lenguas que hablo')} ELSE {WRITINGS} END"
)
#: The day up to which jobs that go on are counted.
AS_OF = "2024-01-01"

P = "p_partkey"

JD_TITLE = "p_name"
JD_TEXT = _lines(
    "''",
    _case(P, 3, "'Aviso de empleo'", "'PUESTO: Especialista en ' || p_type", "'Cargo:  Jefatura de ' || p_type"),
    "'Empresa: ' || p_brand",
    "''",
    "'REQUISITOS OBLIGATORIOS:'",
    f"'- ' || {_s('p_size % 9')} || '+ años con ' || " + _case(P, 2, "'Python y Django'", "'Java o Spark'"),
    "'- Experiencia en PostgreSQL y ' || " + _case(P, 4, "'Redis'", "'Kafka'", "'Docker'", "'Power BI'"),
    _case(P, 3, "'- Bachiller o titulado'", "'- Maestría o licenciatura'", "'- Ganas de aprender'"),
    "'- Inglés ' || " + _case(P, 2, "'B2'", "'avanzado'") + " || ' como mínimo'",
    "''",
    "'REQUISITOS DESEABLES:'",
    "'- Conocimiento de Kubernetes'",
    _case("p_size", 2, "'- Experiencia en AWS o GCP para fintech'", "'Rubro: ' || p_brand"),
    "''",
    "'FUNCIONES:'",
    "'Diseñar procesos de datos. Atender a los equipos de ' || p_type || '. Medir resultados. Otras tareas.'",
    "''",
    "'OFRECEMOS:'",
    "'- Horario flexible'",
)

# A whole CV record as JSON; the case below breaks it in several ways.
_REPLY = (
    "'{{\"candidato_id\":\"id-' || {k} || '\",\"nivel_experiencia\":\"{level}\",\"anos_experiencia\":{years},"
    "\"skills_tecnicos\":[{skills}],\"skills_blandos\":[],\"industrias\":[\"banca\"],"
    "\"cargos_anteriores\":[\"Analista\"],\"nivel_educacion\":\"bachiller\",\"carreras\":[],"
    "\"idiomas\":[{{\"idioma\":\"Inglés\",\"nivel\":\"B' || {b} || '\"}}],\"resumen_perfil\":\"Perfil ' || {k} || '\"{extra}}}'"
)


_B = _s(f"{K} % 2 + 1")
_LEVEL = f"' || CASE WHEN {K} % 2 = 0 THEN 'senior' ELSE 'lead' END || '"


def _reply(level=_LEVEL, years="4", skills=f"\"python\",\"s' || {_B} || '\"", extra="") -> str:
    return _REPLY.format(k=_s(K), b=_B, level=level, years=years, skills=skills, extra=extra)


REPLY_BODY = _case(
    K, 7,
    "'no es json ' || " + _s(K),
    _reply(level="Senior"),
    _reply(years="-1"),
    _reply(years='\"4.5\"'),
    _reply(skills='\"python\",7'),
    _reply().replace('"anos_experiencia":4,', ""),
    _reply(extra=',\"extra\":[1,2]'),
)

# Replies about job descriptions: valid, missing titles, odd years, broken lists.
JD_REPLY_BODY = (
    "'{\"jd_id\":\"jd-' || " + _s("p_partkey") + " || '\",' || "
    + _case("p_partkey", 4, "'\"titulo_puesto\":\"' || p_name || '\",'", "'\"titulo_puesto\":7,'", "''",
            "'\"titulo_puesto\":\"\",'")
    + " || '\"nivel_requerido\":\"' || "
    + _case("p_size", 3, "'lead'", "'junior'", "'experto'")
    + " || '\",\"anos_experiencia_min\":' || "
    + _case("p_size", 5, "'-2'", "'\" 1_0.5 \"'", "'true'", "'\"dos\"'", "'3.25'")
    + " || ',\"skills_requeridos\":[\"sql\"],\"skills_deseables\":' || "
    + _case("p_partkey", 6, "'[null]'", "'null'", "'[]'", "'[\"a\",null]'", "'[\"x\"]'", "'\"x\"'")
    + " || ',\"industria_preferida\":[],\"nivel_educacion_minimo\":\"' || p_type || '\",\"idiomas_requeridos\":[' || "
    + _case("p_partkey", 7, "'{\"idioma\":\"Inglés\"}'", "'{\"idioma\":\"Inglés\",\"nivel\":2}'",
            "'{\"idioma\":\"Inglés\",\"nivel\":\"B2\",\"nota\":1}'", "''")
    + " || '],\"descripcion_rol\":\"rol\"}'"
)

# The id a reply repeats: its own, a wrong one, or that of no known document.
REPLY_DOC = f"CASE WHEN {K} % 11 = 0 THEN -1 - {K} ELSE {K} END"
REPLY_ECHO = f"CASE WHEN {K} % 5 = 0 THEN 'otro' ELSE 'rid-' || {_s(K)} END"

JD_REPLY_ECHO = "CASE WHEN p_partkey % 5 = 0 THEN 'otro' ELSE 'rid-' || " + _s("p_partkey") + " END"

# One request in thirteen has no reply.
JD_REPLY = f"CASE WHEN p_partkey % 13 <> 0 THEN {JD_REPLY_BODY} END"
CV_REPLY = f"CASE WHEN {K} % 13 <> 0 THEN {REPLY_BODY} END"

# Attempts at the requests about CVs: how many, and how the i-th of them ended. One request in seventeen was never sent.
N_TRIES = f"CASE WHEN {K} % 17 = 0 THEN 0 ELSE " + _case(K, 9, "3", "1", "1", "2", "1", "4", "2", "1") + " END"
TRY_CLASS = _case(
    K, 9,
    "'RateLimitError'", "NULL", "'ValueError'", "CASE WHEN i = 1 THEN 'TimeoutError' END", "'ConnectionError'",
    "CASE WHEN i < 4 THEN 'APIError' END", "CASE WHEN i = 1 THEN 'RateLimitError' ELSE 'AuthError' END", "NULL",
)
TRY_MESSAGE = _case(K, 9, "'lento'", "NULL", "'esquema'", "'tarde'", "'red'", "'otra vez'", "'Authentication failed'", "NULL")

ERROR_CLASS = (
    "CASE event_type WHEN 'signup' THEN 'ValueError' WHEN 'error' THEN 'RateLimitError' "
    "WHEN 'click' THEN 'ConnectionError' END"
)
ERROR_MESSAGE = (
    "CASE WHEN event_type = 'click' AND event_id % 4 = 0 THEN 'Invalid API_KEY ' || "
    + _s("event_id")
    + " WHEN event_type IN ('signup', 'error', 'click') THEN 'fallo ' || "
    + _s("event_id")
    + " END"
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _dealt(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Keys to build a corpus from, dealt over the session's shuffle partitions.

    A table of keys is one small file whose texts, built from it, are many times larger. The keys are
    moved, never a text.
    """
    return table(spark, sf_dir, name, *columns).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def cv_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text)"""
    df = _dealt(spark, sf_dir, "customer", K, "c_mktsegment")
    return df.select(F.col(K).alias("doc_id"), F.expr(CV_TEXT).alias("text"))


def free_cv_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): CVs in several writings."""
    df = _dealt(spark, sf_dir, "customer", K).select(F.col(K).alias("doc_id"), F.expr(_FREE_CV).alias("text"))
    return df.select("doc_id", F.expr(WRITINGS).alias("text"))


def strange_cv_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): CVs in several writings, one in three with headings of its own."""
    df = _dealt(spark, sf_dir, "customer", K).select(F.col(K).alias("doc_id"), F.expr(_FREE_CV).alias("text"))
    return df.select("doc_id", F.expr(STRANGE_HEADS).alias("text"))


def jd_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, title, text)"""
    df = _dealt(spark, sf_dir, "part", P, "p_name", "p_brand", "p_type", "p_size")
    return df.select(F.col(P).alias("doc_id"), F.expr(JD_TITLE).alias("title"), F.expr(JD_TEXT).alias("text"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, body)"""
    df = _dealt(spark, sf_dir, "customer", K)
    return df.select(F.col(K).alias("doc_id"), F.expr(REPLY_BODY).alias("body"))


def cv_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, i, error_class, message)"""
    df = _dealt(spark, sf_dir, "customer", K)
    rows = df.select(K, F.expr(f"explode(CASE WHEN {N_TRIES} > 0 THEN sequence(1, {N_TRIES}) END)").alias("i"))
    return rows.select(F.col(K).alias("doc_id"), "i", F.expr(TRY_CLASS).alias("error_class"), F.expr(TRY_MESSAGE).alias("message"))


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, day, ts, event_id, error_class, message); a user's day is a request."""
    df = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    return df.select(
        "user_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        "ts",
        "event_id",
        F.expr(ERROR_CLASS).alias("error_class"),
        F.expr(ERROR_MESSAGE).alias("message"),
    )


# The same corpora for DuckDB.
CV_SQL = f"SELECT {K} AS doc_id, {CV_TEXT} AS text FROM customer"
PLAIN_CV_SQL = f"SELECT {K} AS doc_id, {_FREE_CV} AS text FROM customer"
FREE_CV_SQL = f"SELECT doc_id, {WRITINGS} AS text FROM (SELECT {K} AS doc_id, {_FREE_CV} AS text FROM customer)"
JD_SQL = f"SELECT {P} AS doc_id, {JD_TITLE} AS title, {JD_TEXT} AS text FROM part"
REPLIES_SQL = f"SELECT {K} AS doc_id, {REPLY_BODY} AS body FROM customer"
TRIES_SQL = f"SELECT {K} AS doc_id, i, {TRY_CLASS} AS error_class, {TRY_MESSAGE} AS message FROM customer, range(1, 5) AS t(i) WHERE i <= {N_TRIES}"
ATTEMPTS_SQL = (
    "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, ts, event_id, "
    f"{ERROR_CLASS} AS error_class, {ERROR_MESSAGE} AS message FROM events"
)
