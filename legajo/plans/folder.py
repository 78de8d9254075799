"""From a folder of files to checked records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legajo.functions import text as T
from legajo.operators import records
from legajo.operators.validate import keep_together
from legajo.sources import files, office


def texts(scanned: DataFrame) -> DataFrame:
    """(path, stem, text, problem) of scanned files, one row each.

    Pages and paragraphs of a file are joined in the row they come in, so
    nothing is shuffled. ``problem`` tells why ``text`` is null: ``decode`` for
    bytes that are not UTF-8, ``docx`` or ``pdf`` for files their reader could
    not open or has no reader for.
    """
    only = lambda kind: F.when(F.col("kind") == kind, F.col("content"))
    routed = files.route_by_suffix(scanned).withColumn("_plain", only("text"))
    routed = files.decode_text(routed, "_plain")
    routed = routed.withColumn("_docx", office.docx_paragraphs(only("docx")))
    pages = office.pdf_pages(only("pdf")) if office.has_pdf_reader() else F.lit(None).cast("array<string>")
    routed = routed.withColumn("_pdf", pages)
    text = (
        F.when(F.col("kind") == "docx", office.join_paragraphs(F.col("_docx")))
        .when(F.col("kind") == "pdf", office.join_pages(F.col("_pdf")))
        .otherwise(F.col("text"))
    )
    problem = F.when(F.col("kind") == "text", "decode").otherwise(F.col("kind"))
    return routed.withColumn("text", text).select(
        "path", "stem", "text", F.when(F.col("text").isNull(), problem).alias("problem")
    )


def _named(built: DataFrame) -> DataFrame:
    """A reading problem takes the place of the errors that follow from it."""
    problem = F.col("problem")
    errors = F.when(problem.isNotNull(), F.array(problem)).otherwise(F.col("errors"))
    return keep_together(built.select("path", "record", errors.alias("errors")), "record", "errors")


def cv_records_of(docs: DataFrame, salt: str, as_of: Column | None = None) -> DataFrame:
    """(path, record, errors) from what ``texts`` gives, batch or stream; jobs are counted up to ``as_of``."""
    return _named(records.build_cv_records(docs, salt, doc="path", carry=["problem"], as_of=as_of))


def cv_records(
    spark: SparkSession, folder: str, salt: str, manifest: DataFrame | None = None, as_of: Column | None = None
) -> DataFrame:
    """(path, record, errors) for each CV file."""
    return cv_records_of(texts(files.scan_documents(spark, folder, manifest=manifest)), salt, as_of)


def jd_records(
    spark: SparkSession,
    folder: str,
    salt: str,
    titles: DataFrame | None = None,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """(path, record, errors) for each job-description file.

    ``titles`` (path, title) gives titles; a file without one is named after
    its stem.
    """
    docs = texts(files.scan_documents(spark, folder, manifest=manifest))
    # The record is built without a title, so that no text goes through the join with the titles.
    docs = docs.withColumn("title", F.lit(T.NO_TITLE))
    built = records.build_jd_records(docs, salt, doc="path", carry=["problem", "stem"])
    if titles is None:
        given = T.title_from_stem(F.col("stem"))
    else:
        built = built.join(titles.select("path", "title"), "path", "left")
        given = T.title_or_stem(F.col("title"), F.col("stem"))
    title = T.title_fallback(F.col("record.titulo_puesto"), given)
    return _named(built.withColumn("record", F.col("record").withField("titulo_puesto", title)))
