"""From raw documents to token ids: quality, near-duplicates, secrets, mix, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legajo.llm import bpe, minhash, mixing, quality, secrets
from legajo.llm.scratch import saved, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the cutoffs of their language let pass.

    Cutoffs come from a table of numbers; the texts are measured again where they are judged and not shuffled.
    """
    numbers = saved(quality.measured(docs.select("doc_id", "lang", "text")).drop("text"), "quality")
    cuts = quality.cutoffs(numbers, table(spark, sf_dir, "labels"))
    return quality.judged(quality.measured(docs), cuts).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies at a similarity of 0.8, one row of it.

    Documents without an id are in no group and stay.
    """
    kept = minhash.near_duplicates(docs, percent=80).filter("kept and doc_id is not null").select("doc_id").distinct()
    rows = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return rows.select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts and ``n_chars`` of masked texts counted anew."""
    found = saved(secrets.candidates(docs.select("source", "text")), "findings")
    forest = secrets.fit(secrets.drawn_findings(spark).unionByName(secrets.corpus_findings(found)))
    rows = secrets.masked(docs, forest, mark=MARK)
    masked = F.coalesce(F.contains("text", F.lit(MARK)), F.lit(False))
    return rows.withColumn("n_chars", F.when(masked, F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: files by name, and rows in them."""
    return mixing.mixed(docs, mixing.tempered_parts(docs))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of every document, with its place in the mix where ``docs`` was read from files."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    try:
        docs = docs.select("*", F.col("_metadata.file_name").alias("mix_file"), F.col("_metadata.row_index").alias("mix_row"))
    except AnalysisException:
        docs = docs.select("*", F.lit(None).cast("string").alias("mix_file"), F.lit(None).cast("long").alias("mix_row"))
    docs = docs.select("doc_id", "lang", "source", "mix_file", "mix_row", "text")
    ids = bpe.encode(docs, path, pattern, digest=True).drop("text")
    return ids.withColumns({"n_tokens": F.floor(F.octet_length("token_ids") / 4), "ids_sha256": F.sha2("token_ids", 256)})


MARK = "[secret]"
STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scans", secret_scans),
    ("mixing sources", mixed_sources),
    ("byte-level BPE", byte_bpe),
]
#: Signatures, forests and merges are no SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
