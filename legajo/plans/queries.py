"""One query per operator, each over whole tables or corpora derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legajo.functions import errors
from legajo.functions import extract as X
from legajo.functions import redact as R
from legajo.functions import text as T
from legajo.functions.contract import CV_RULES, JD_RULES, record_schema
from legajo.operators import anonymize as A
from legajo.operators import assemble, attempts, correlate, extract, match, ranked, records, requests, segment, validate
from legajo.plans import corpora as C
from legajo.plans import replies as lifecycle
from legajo.session import scratch_path
from legajo.sources import files, sinks

SALT = "sal"
PRICE_PER_1K = 0.15

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _joined(items: Column) -> Column:
    """An array as one string, so that any engine compares it alike."""
    return F.array_join(items, "; ")


def _languages(items: Column) -> Column:
    return _joined(F.transform(items, lambda i: F.concat_ws("=", i["idioma"], i["nivel"])))


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return C.table(spark, sf_dir, "documents", "doc_id", "text", *columns)


# Scans, sources, sinks


@query
def scan_documents(spark, sf_dir):
    folder = scratch_path(spark, "scan")
    items = C.table(spark, sf_dir, "benchmark", "item_id", "text")
    sinks.write_documents_text(items, folder, "item_id", file_each=True)
    found = files.route_by_suffix(files.scan_documents(spark, folder, "*.[tT][xX][tT]"))
    return found.select(
        F.regexp_extract("path", r"/item_id=([0-9]+)/[^/]+$", 1).cast("long").alias("item_id"),
        "suffix",
        "kind",
        (F.concat("stem", "suffix") == F.col("name")).alias("parts_ok"),
        F.length("content").cast("long").alias("n_bytes"),
        F.md5("content").alias("digest"),
    )


@query
def route_by_suffix(spark, sf_dir):
    parts = C.table(spark, sf_dir, "part", "p_partkey", "p_name")
    endings = "element_at(array('.pdf', '.DOCX', '.doc', '.txt', '', '.tar.PDF'), int(p_partkey % 6) + 1)"
    path = F.concat(F.lit("dir.d/"), F.translate("p_name", " ", "-"), F.expr(endings))
    named = files.with_name_parts(parts.withColumn("path", path))
    return files.route_by_suffix(named).select("p_partkey", "name", "stem", "suffix", "kind")


@query
def decode_text(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    utf8 = lambda c: F.encode(c, "utf-8")
    content = (
        F.when(F.col("doc_id") % 4 == 0, utf8(F.replace("text", F.lit("\n"), F.lit("\r\n"))))
        .when(F.col("doc_id") % 4 == 1, utf8(F.translate("text", "\n", "\r")))
        .when(F.col("doc_id") % 4 == 2, utf8(F.concat(F.lit("\ufeff"), "text")))
        .otherwise(F.concat(utf8("text"), F.unhex(F.lit("FF"))))
    )
    decoded = files.decode_text(docs.select("doc_id", content.alias("content")))
    return decoded.select(
        "doc_id", "decode_ok", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest")
    )


@query
def assemble_pages(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return assemble.assemble_pages(turns, "conv_id", "turn", "text")


@query
def assemble_paragraphs(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    blank = (F.col("turn") % 3 == 1) | (F.col("conv_id") % 7 == 0)
    holed = turns.withColumn("text", F.when(blank, " \t ").otherwise(F.col("text")))
    return assemble.assemble_paragraphs(holed, "conv_id", "turn", "text")


@query
def write_records_json(spark, sf_dir):
    path = scratch_path(spark, "records")
    good, _ = validate.split_quarantine(validate.validate_cv(C.replies(spark, sf_dir)))
    sinks.write_records_json(good, path)
    back = sinks.read_records_json(spark, path, record_schema(CV_RULES))
    return back.select(
        "candidato_id",
        "nivel_experiencia",
        "anos_experiencia",
        _joined(F.col("skills_tecnicos")).alias("skills_tecnicos"),
        F.size("certificaciones").cast("long").alias("n_certificaciones"),
        _languages(F.col("idiomas")).alias("idiomas"),
        "resumen_perfil",
    )


@query
def write_documents_text(spark, sf_dir):
    path = scratch_path(spark, "texts")
    sinks.write_documents_text(_documents(spark, sf_dir), path)
    back = sinks.read_documents_text(spark, path)
    return back.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.md5("text").alias("digest"),
    )


# Masking


def _on_cvs(spark, sf_dir, rewrite) -> DataFrame:
    return C.cv_corpus(spark, sf_dir).select("doc_id", rewrite(F.col("text")).alias("text"))


@query
def redact_email(spark, sf_dir):
    return _on_cvs(spark, sf_dir, R.redact_email)


@query
def redact_dni(spark, sf_dir):
    return _on_cvs(spark, sf_dir, R.redact_dni)


@query
def redact_ruc(spark, sf_dir):
    return _on_cvs(spark, sf_dir, R.redact_ruc)


@query
def redact_phone(spark, sf_dir):
    return _on_cvs(spark, sf_dir, R.redact_phone)


@query
def mask_name_line(spark, sf_dir):
    return _on_cvs(spark, sf_dir, R.mask_name_line)


@query
def anonymize(spark, sf_dir):
    return A.anonymize(_documents(spark, sf_dir)).select("doc_id", "text_anon")


@query
def anonymize_cvs(spark, sf_dir):
    return A.anonymize(C.cv_corpus(spark, sf_dir)).select("doc_id", "text_anon")


@query
def mask_names(spark, sf_dir):
    masked = A.anonymize(C.free_cv_corpus(spark, sf_dir), names=True)
    tags = F.regexp_count("text_anon", F.lit(r"\[NOMBRE_REDACTADO\]")).cast("long")
    return masked.select("doc_id", tags.alias("tags"), F.md5("text_anon").alias("digest"))


@query
def pii_audit(spark, sf_dir):
    return A.pii_audit(_documents(spark, sf_dir, "source"), ["source"])


@query
def pii_audit_cvs(spark, sf_dir):
    cvs = C.cv_corpus(spark, sf_dir).withColumn("grp", F.col("doc_id") % 5)
    return A.pii_audit(cvs, ["grp"])


# Projections and scalar functions


@query
def title_from_stem(spark, sf_dir):
    parts = C.table(spark, sf_dir, "part", "p_partkey", "p_name")
    joint = F.when(F.col("p_partkey") % 2 == 0, "_").otherwise("-")
    stem = F.concat(F.replace("p_name", F.lit(" "), joint), F.lit("-o'ñ"), F.col("p_partkey"), F.lit("ops"))
    return parts.select("p_partkey", T.title_from_stem(stem).alias("title"))


@query
def truncate_text(spark, sf_dir):
    masked = A.anonymize(_documents(spark, sf_dir))
    cut = masked.select("doc_id", T.truncate_text(F.col("text_anon"), T.CV_CHARS).alias("cut"))
    return cut.select("doc_id", F.length("cut").cast("long").alias("n_chars"), "cut")


@query
def record_id(spark, sf_dir):
    people = C.table(spark, sf_dir, "customer", "c_custkey")
    return people.select("c_custkey", T.record_id(F.col("c_custkey"), SALT).alias("record_id"))


@query
def render_cv_request(spark, sf_dir):
    return requests.render_cv_request(A.anonymize(C.cv_corpus(spark, sf_dir)), SALT)


@query
def request_payloads(spark, sf_dir):
    asked, _ = lifecycle.cv_requests(C.cv_corpus(spark, sf_dir), SALT, "local", "modelo-1")
    read = lambda path: F.get_json_object("payload", path)
    return asked.select(
        "doc_id",
        read("$.messages[0].role").alias("first_role"),
        F.md5(read("$.messages[1].content")).alias("user_digest"),
        read("$.max_tokens").cast("int").alias("max_tokens"),
        read("$.model").alias("model"),
    )


@query
def render_jd_request(spark, sf_dir):
    return requests.render_jd_request(C.jd_corpus(spark, sf_dir), SALT)


@query
def token_estimate(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", T.token_estimate(F.col("text")).alias("tokens"))


@query
def title_fallback(spark, sf_dir):
    parts = C.table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type")
    k = F.col("p_partkey") % 5
    read = F.when(k == 0, "").when(k == 1, T.NO_TITLE).when(k == 2, " ").when(k == 3, F.col("p_name"))
    return parts.select("p_partkey", T.title_fallback(read, F.col("p_type")).alias("title"))


@query
def list_preview(spark, sf_dir):
    items = F.split("text", " ")
    return _documents(spark, sf_dir).select("doc_id", T.list_preview(items).alias("preview"))


@query
def line_preview(spark, sf_dir):
    masked = A.anonymize(_documents(spark, sf_dir))
    return masked.select("doc_id", T.line_preview(F.col("text_anon")).alias("preview"))


# Joins, aggregates, windows


@query
def correlate_responses(spark, sf_dir):
    people = C.table(spark, sf_dir, "customer", "c_custkey")
    asked = people.select(
        F.col("c_custkey").alias("doc_id"), F.concat(F.lit("rid-"), "c_custkey").alias("record_id")
    )
    answers = people.select(F.expr(C.REPLY_DOC).alias("doc_id"), F.expr(C.REPLY_ECHO).alias("rid"))
    return correlate.correlate_responses(asked, answers).select("doc_id", "record_id", "rid", "status")


@query
def token_rollup(spark, sf_dir):
    """Masked, cut, priced: what sending the documents would cost per language."""
    masked = A.anonymize(_documents(spark, sf_dir, "lang"))
    cut = masked.withColumn("cut", T.truncate_text(F.col("text_anon"), T.CV_CHARS))
    sized = cut.withColumn("tokens", T.token_estimate(F.col("cut")))
    return requests.token_rollup(sized, ["lang"], PRICE_PER_1K)


@query
def resolve_attempts(spark, sf_dir):
    log = C.attempt_log(spark, sf_dir)
    numbered = attempts.number_attempts(log, ["user_id", "day"], ["ts", "event_id"])
    return attempts.resolve_attempts(numbered, ["user_id", "day"])


@query
def classify_error(spark, sf_dir):
    log = C.attempt_log(spark, sf_dir)
    verdict = errors.classify_error(F.col("error_class"), F.col("message"))
    return log.select("event_id", verdict.alias("verdict"))


# JSON and validation


@query
def parse_response(spark, sf_dir):
    parsed = validate.parse_response(C.replies(spark, sf_dir), CV_RULES)
    r = F.col("record")
    return parsed.select(
        "doc_id",
        "is_json",
        r["candidato_id"].alias("candidato_id"),
        r["nivel_experiencia"].alias("nivel_experiencia"),
        r["anos_experiencia"].alias("anos_experiencia"),
        _languages(r["idiomas"]).alias("idiomas"),
        r["resumen_perfil"].alias("resumen_perfil"),
    )


@query
def validate_cv(spark, sf_dir):
    checked = validate.validate_cv(C.replies(spark, sf_dir))
    return checked.select("doc_id", _joined(F.col("errors")).alias("errors"))


@query
def validate_jd(spark, sf_dir):
    df = C.table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size")
    sent = df.select(F.col("p_partkey").alias("doc_id"), F.expr(C.JD_REPLY_BODY).alias("body"))
    checked = validate.validate_jd(sent)
    return checked.select(
        "doc_id",
        _joined(F.col("errors")).alias("errors"),
        F.col("record.anos_experiencia_min").alias("years"),
        F.col("record.titulo_puesto").alias("title"),
    )


@query
def jd_records_from_replies(spark, sf_dir):
    parts = C.table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size")
    key = F.col("p_partkey").alias("doc_id")
    asked = parts.select(key, F.concat(F.lit("rid-"), "p_partkey").alias("record_id"))
    sent = parts.select(key, F.expr(C.JD_REPLY).alias("body"), F.expr(C.JD_REPLY_ECHO).alias("rid"))
    built = lifecycle.jd_records(asked, sent, parts.select(key, F.col("p_name").alias("title")))
    return built.select(
        "doc_id",
        "status",
        _joined(F.col("errors")).alias("errors"),
        F.col("record.titulo_puesto").alias("title"),
        F.col("record.anos_experiencia_min").alias("years"),
    )


@query
def cv_records_from_replies(spark, sf_dir):
    """Attempts resolved, replies met, checked and split; records and quarantine as they are read back."""
    people = C.table(spark, sf_dir, "customer", "c_custkey")
    asked = people.select(F.col("c_custkey").alias("doc_id"), F.concat(F.lit("rid-"), "c_custkey").alias("record_id"))
    sent = people.select(F.expr(C.REPLY_DOC).alias("doc_id"), F.expr(C.REPLY_ECHO).alias("rid"), F.expr(C.CV_REPLY).alias("body"))
    folder = scratch_path(spark, "cv-replies")
    lifecycle.write_cv_records(lifecycle.cv_records(asked, C.cv_tries(spark, sf_dir), sent, ["i"]), folder)
    good = sinks.read_records_json(spark, f"{folder}/records", record_schema(CV_RULES))
    kept = "doc_id long, status string, attempts long, wait_s long, body string, errors array<string>"
    bad = spark.read.schema(kept).json(f"{folder}/quarantine")
    none = F.lit(None)
    good = good.select(
        F.lit("good").alias("side"), F.col("candidato_id").alias("key"), F.lit("matched").alias("status"), none.cast("long").alias("attempts"),
        none.cast("long").alias("wait_s"), F.lit("").alias("errors"), F.col("anos_experiencia").alias("years"), none.cast("string").alias("digest"),
    )
    bad = bad.select(
        F.lit("quarantine").alias("side"), F.col("doc_id").cast("string").alias("key"), "status", "attempts", "wait_s", _joined(F.col("errors")).alias("errors"),
        none.cast("double").alias("years"), F.md5("body").alias("digest"),
    )
    return good.unionByName(bad)


@query
def split_quarantine(spark, sf_dir):
    checked = validate.validate_cv(C.replies(spark, sf_dir))
    good, bad = validate.split_quarantine(checked, scratch_path(spark, "sides"))
    good = good.select("doc_id", F.lit("good").alias("side"), F.lit(None).cast("string").alias("raw"), F.lit("").alias("errors"))
    bad = bad.select("doc_id", F.lit("quarantine").alias("side"), F.col("body").alias("raw"), _joined(F.col("errors")).alias("errors"))
    return good.unionByName(bad)


# Extraction


@query
def tag_sections(spark, sf_dir):
    return extract.tag_sections(C.jd_corpus(spark, sf_dir))


@query
def tag_sections_documents(spark, sf_dir):
    return extract.tag_sections(_documents(spark, sf_dir))


@query
def segment_sections(spark, sf_dir):
    """Sections of CVs whose headings are written anyhow or unknown, by costs learned from CVs with known ones."""
    costs = segment.learn(C.free_cv_corpus(spark, sf_dir))
    cut = segment.segmented(C.strange_cv_corpus(spark, sf_dir), costs)
    return cut.select("doc_id", F.explode_outer("sections").alias("s")).select("doc_id", F.col("s.start").alias("start"), F.col("s.section").alias("part"))


@query
def extract_terms(spark, sf_dir):
    found = extract.extract_terms(C.cv_corpus(spark, sf_dir))
    return found.select("doc_id", *[_joined(F.col(c)).alias(c) for c in found.columns[1:]])


@query
def extract_terms_table(spark, sf_dir):
    brands = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_type", "p_size")
    names = brands.select(F.lower("p_type").alias("term"), F.lit("rubro").alias("category"))
    sizes = brands.select(F.concat(F.col("p_size") % 9, F.lit("+ años")).alias("term"), F.lit("plazo").alias("category"))
    lexicon = names.union(sizes).distinct()
    jds = C.jd_corpus(spark, sf_dir)
    found = extract.extract_terms_table(jds, lexicon, ["rubro", "plazo"])
    return found.select("doc_id", _joined(F.col("rubro")).alias("rubro"), _joined(F.col("plazo")).alias("plazo"))


@query
def extract_years(spark, sf_dir):
    return extract.extract_years(C.cv_corpus(spark, sf_dir))


@query
def experience_from_jobs(spark, sf_dir):
    as_of = F.lit(C.AS_OF).cast("date")
    return extract.experience_from_jobs(C.free_cv_corpus(spark, sf_dir), as_of)


@query
def infer_level(spark, sf_dir):
    years = extract.extract_years(C.jd_corpus(spark, sf_dir))
    return years.select("doc_id", X.infer_level(F.col("years")).alias("level"))


@query
def extract_education(spark, sf_dir):
    both = [C.cv_corpus(spark, sf_dir), C.jd_corpus(spark, sf_dir).drop("title")]
    kinds = [extract.extract_education(d).withColumn("kind", F.lit(k)) for d, k in zip(both, ("cv", "jd"))]
    return kinds[0].unionByName(kinds[1])


@query
def extract_languages(spark, sf_dir):
    found = extract.extract_languages(C.cv_corpus(spark, sf_dir))
    return found.select("doc_id", _languages(F.col("languages")).alias("languages"))


@query
def language_mentions(spark, sf_dir):
    jds = C.jd_corpus(spark, sf_dir)
    return jds.select("doc_id", _languages(X.language_mentions(F.col("text"))).alias("languages"))


@query
def extract_positions(spark, sf_dir):
    found = extract.extract_positions(C.cv_corpus(spark, sf_dir))
    return found.select("doc_id", _joined(F.col("positions")).alias("positions"))


@query
def extract_careers(spark, sf_dir):
    found = extract.extract_careers(C.cv_corpus(spark, sf_dir))
    return found.select("doc_id", _joined(F.col("careers")).alias("careers"))


@query
def title_or_stem(spark, sf_dir):
    parts = C.table(spark, sf_dir, "part", "p_partkey", "p_name")
    given = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, "")
    stem = F.concat(F.lit("puesto-"), F.translate("p_name", " ", "_"))
    return parts.select("p_partkey", T.title_or_stem(given, stem).alias("title"))


@query
def fatal_reason(spark, sf_dir):
    log = C.attempt_log(spark, sf_dir)
    return log.select("event_id", errors.fatal_reason(F.col("error_class"), F.col("message")).alias("reason"))


@query
def split_requirements(spark, sf_dir):
    found = extract.split_requirements(C.jd_corpus(spark, sf_dir))
    return found.select("doc_id", *[_joined(F.col(c)).alias(c) for c in found.columns[1:]])


@query
def extract_job_title(spark, sf_dir):
    return extract.extract_job_title(C.jd_corpus(spark, sf_dir))


@query
def summarize(spark, sf_dir):
    return extract.summarize(_documents(spark, sf_dir), plain=True)


@query
def summarize_cvs(spark, sf_dir):
    return extract.summarize(C.cv_corpus(spark, sf_dir))


def _flat(built: DataFrame, rules) -> DataFrame:
    cols = []
    for rule in rules:
        value = F.col("record")[rule.name]
        if rule.kind == "list_str":
            value = _joined(value)
        elif rule.kind == "list_struct":
            value = _languages(value)
        cols.append(value.alias(rule.name))
    return built.select("doc_id", *cols, _joined(F.col("errors")).alias("errors"))


def _cv_records(corpus: DataFrame, costs: segment.Costs | None = None) -> DataFrame:
    return _flat(records.build_cv_records(corpus, SALT, as_of=F.lit(C.AS_OF).cast("date"), costs=costs), CV_RULES)


@query
def summarize_ranked(spark, sf_dir):
    return ranked.summarize_ranked(_documents(spark, sf_dir), plain=True)


@query
def summarize_ranked_cvs(spark, sf_dir):
    return ranked.summarize_ranked(C.cv_corpus(spark, sf_dir))


@query
def build_cv_records(spark, sf_dir):
    return _cv_records(C.cv_corpus(spark, sf_dir))


@query
def build_free_cv_records(spark, sf_dir):
    """Records of CVs in any writing; no name, address or contact may reach one."""
    return _cv_records(C.free_cv_corpus(spark, sf_dir))


@query
def build_strange_cv_records(spark, sf_dir):
    """Records of CVs with headings that no list knows: the same as with known ones."""
    return _cv_records(C.strange_cv_corpus(spark, sf_dir), segment.learn(C.free_cv_corpus(spark, sf_dir)))


@query
def build_jd_records(spark, sf_dir):
    return _flat(records.build_jd_records(C.jd_corpus(spark, sf_dir), SALT), JD_RULES)


@query
def match_cvs_to_jds(spark, sf_dir):
    cvs = records.build_cv_records(C.cv_corpus(spark, sf_dir), SALT, as_of=F.lit(C.AS_OF).cast("date")).select(
        F.col("doc_id").alias("cv"),
        F.col("record.skills_tecnicos").alias("skills"),
        F.col("record.anos_experiencia").alias("years"),
        F.col("record.nivel_educacion").alias("degree"),
    )
    jds = records.build_jd_records(C.jd_corpus(spark, sf_dir), SALT).select(
        F.col("doc_id").alias("jd"),
        F.col("record.skills_requeridos").alias("must"),
        F.col("record.skills_deseables").alias("nice"),
        F.col("record.anos_experiencia_min").alias("years"),
        F.col("record.nivel_educacion_minimo").alias("degree"),
    )
    return match.top_matches(cvs, jds, k=5)
