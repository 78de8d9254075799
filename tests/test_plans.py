"""Plans: no Python, no shuffle where none is due, no repeated work."""

import pytest
from pyspark.sql import functions as F

from legajo.plans.queries import REGISTRY
from legajo.operators import records
from legajo.operators.anonymize import anonymize
from legajo.operators.extract import tag_sections
from legajo.operators.validate import CV_RULES, validate_response

SF = "/root/testdata/sf0.001"
WRITERS = {"scan_documents", "write_records_json", "write_documents_text", "split_quarantine", "cv_records_from_replies"}
# Operators that bring rows of one key together, and the shuffles they need.
SHUFFLES = {
    "assemble_pages": 1,
    "assemble_paragraphs": 1,
    "pii_audit": 1,
    "pii_audit_cvs": 1,
    "token_rollup": 1,
    "resolve_attempts": 1,
    "correlate_responses": 1,
    "extract_terms_table": 2,
    "jd_records_from_replies": 1,
    # The last step only: rounds before it are written.
    "match_cvs_to_jds": 1,
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in REGISTRY if n not in WRITERS])
def test_query_plan(spark, name):
    plan = plan_of(REGISTRY[name](spark, SF))
    assert not any(p in plan for p in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"))
    assert plan.count("Exchange hashpartitioning") == SHUFFLES.get(name, 0)
    # The lengths of a lexicon's terms are one aggregate, of partial ones.
    assert name == "extract_terms_table" or "Exchange SinglePartition" not in plan


def test_masking_runs_each_regex_once_per_path(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = plan_of(anonymize(df).select("doc_id", "text_anon"))
    # Four for texts split into lines, four for those masked whole.
    assert plan.count("regexp_replace(") == 8
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_sections_are_cut_once(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert plan_of(tag_sections(df)).count("split(") == 1


def test_records_are_built_in_one_narrow_stage(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    built = records.build_cv_records(df, "s").filter(F.size("errors") == 0)
    plan = plan_of(built)
    # Nine that mask, one each for record id, blank lead, names, and two for headings.
    assert "Exchange" not in plan and plan.count("regexp_replace(") <= 15


def test_a_filter_on_errors_does_not_repeat_the_checks(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("body"))
    plain = plan_of(validate_response(df, CV_RULES))
    filtered = plan_of(validate_response(df, CV_RULES).filter(F.size("errors") == 0))
    assert len(filtered) < len(plain) * 1.1
