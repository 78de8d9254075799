"""Typed records from documents, checked by the same rules as model replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions import extract as X
from legajo.functions import lexicon as L
from legajo.functions import text as T
from legajo.functions.patterns import SPACE
from legajo.operators.anonymize import anonymize
from legajo.operators import segment
from legajo.operators.extract import summary, with_sections, with_words
from legajo.operators.validate import keep_together
from legajo.functions.contract import CV_RULES, JD_RULES, FieldRule


# Without a section to take it from a summary is empty, which fails the record.
_SUMMARIES = ("resumen_perfil", "descripcion_rol")
# What is looked for among the words of a document.
_LISTED = (*L.TERMS, *L.DEGREE_WORDS)


def _checked(
    df: DataFrame, fields: dict[str, Column], rules: Sequence[FieldRule], keep: Sequence[str], text: str
) -> DataFrame:
    """(``keep``, record, errors); blank documents fail as such.

    The fields are computed as columns of their own first, because the record
    and the checks both read them.
    """
    blank = ~F.rlike(F.col(text), F.lit(rf"[^{SPACE}]"))
    values = [fields[rule.name].alias(rule.name) for rule in rules]
    flat = df.select(*[F.col(k).alias(f"_{k}") for k in keep], blank.alias("_blank"), *values)
    bad = [F.when(F.coalesce(F.col("_blank"), F.lit(True)), "text")]
    for rule in rules:
        value = F.col(rule.name)
        wrong = value.isNull()
        if rule.name in _SUMMARIES:
            wrong = wrong | (value == "")
        if rule.values:
            wrong = wrong | ~value.isin(*rule.values)
        if rule.minimum is not None:
            wrong = wrong | (value < rule.minimum)
        bad.append(F.when(wrong, rule.name))
    checked = flat.select(
        *[F.col(f"_{k}").alias(k) for k in keep],
        F.struct(*[F.col(rule.name) for rule in rules]).alias("record"),
        F.array_compact(F.array(*bad)).alias("errors"),
    )
    return keep_together(checked, "record", "errors")


def build_cv_records(
    df: DataFrame,
    salt: str,
    doc: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    as_of: Column | None = None,
    costs: segment.Costs | None = None,
) -> DataFrame:
    """(``doc``, ``carry``, record, errors) for each CV, from its masked text.

    Experience is what the text says or, given ``as_of``, the larger of that and what its dated jobs cover up to that day;
    without it no record depends on the day it is made. Names that the text gives are masked wherever it mentions them, and a summary
    takes no line that may say who or where a person is.

    Sections begin at known headings or, given ``costs`` that ``segment.learn`` found, where a text's lines say so, whatever its headings.

    One narrow job from raw text to checked record: no shuffle at any size. The
    whole text is read; the cut belongs to requests only.
    """
    masked, hits = F.col("text_anon"), F.col("_hits")
    if costs is None:
        part = lambda name: X.section_lines(F.col("sections"), L.SECTIONS[name])
    else:
        part = lambda name: segment.part_lines(F.col("sections"), name)
    terms = lambda known: X.found_terms(hits, F.col("_spaced"), known)
    said = F.coalesce(X.years_required(masked), F.lit(0.0))
    plain = df.select(doc, *carry, F.col(text), T.plain_breaks(F.col(text)).alias("_plain"))
    masked_text = anonymize(plain, "_plain", skip_blank_lead=True, names=True)
    cut = with_sections(masked_text, "text_anon", known=True) if costs is None else segment.segmented(masked_text, costs, "text_anon")
    read = with_words(cut, "text_anon", _LISTED)
    read = read.withColumn("_profile", part("profile")).withColumn("_jobs", part("experience"))
    if as_of is None:
        read = read.withColumn("_years", said)
    else:
        months = F.coalesce(X.covered_months(X.job_spans(F.col("_jobs"), as_of)), F.lit(0))
        read = read.withColumn("_years", F.greatest(said, F.round(months / 12, 1)))
    fields = {
        "candidato_id": T.record_id(F.col(doc), salt),
        "nivel_experiencia": X.infer_level(F.col("_years")),
        "anos_experiencia": F.col("_years"),
        "skills_tecnicos": terms(L.TECHNICAL),
        "skills_blandos": terms(L.SOFT),
        "industrias": terms(L.INDUSTRIES),
        "cargos_anteriores": X.dated_titles(F.col("_jobs")),
        "nivel_educacion": X.degree(hits, highest=True),
        "carreras": X.dated_titles(part("education")),
        "certificaciones": terms(L.CERTIFICATES),
        "idiomas": X.language_pairs(part("languages")),
        "resumen_perfil": summary(F.col("_profile"), public=True),
    }
    return _checked(read, fields, CV_RULES, [doc, *carry], text)


def build_jd_records(
    df: DataFrame,
    salt: str,
    doc: str = "doc_id",
    text: str = "text",
    title: str = "title",
    carry: Sequence[str] = (),
) -> DataFrame:
    """(``doc``, ``carry``, record, errors) for each job description, read as it is.

    ``title`` holds the title given for the document.
    """
    raw, hits = F.col(text), F.col("_hits")
    part = lambda name: X.section_lines(F.col("sections"), L.SECTIONS[name])
    terms = lambda known, of="": X.found_terms(F.col(f"{of}_hits"), F.col(f"{of}_spaced"), known)
    # What the required items say goes before what the rest does.
    asked_for = X.years_required(F.array_join(part("mandatory"), "\n"))
    years = F.coalesce(asked_for, X.years_required(raw), F.lit(0.0))
    read = with_sections(df.select(doc, *carry, text, title), text, known=True)
    read = with_words(read, text, _LISTED).withColumn("_years", years)
    for name, section in (("must", "mandatory"), ("nice", "desirable")):
        read = read.withColumn(f"_{name}", F.array_join(X.bullets(part(section)), " | "))
        read = with_words(read, f"_{name}", L.TECHNICAL, name)
    # Without a section on the role: text outside lists, else what is asked for.
    free, asked = X.free_lines(F.col("sections")), part("mandatory")
    role = F.when(F.size(part("role")) > 0, part("role")).when(F.size(free) > 0, free).otherwise(asked)
    read = read.withColumn("_role", role)
    fields = {
        "jd_id": T.record_id(F.col(doc), salt),
        "titulo_puesto": T.title_fallback(X.labelled_title(raw), F.col(title)),
        "nivel_requerido": X.infer_level(F.col("_years")),
        "anos_experiencia_min": F.col("_years"),
        "skills_requeridos": terms(L.TECHNICAL, "must"),
        "skills_deseables": terms(L.TECHNICAL, "nice"),
        "industria_preferida": terms(L.INDUSTRIES),
        "nivel_educacion_minimo": F.coalesce(X.degree(hits, highest=False), F.lit(L.NO_DEGREE)),
        "idiomas_requeridos": X.language_mentions(raw),
        "descripcion_rol": summary(F.col("_role")),
    }
    return _checked(read, fields, JD_RULES, [doc, *carry], text)
