"""Writing records as JSON and document texts as text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Ends one document in a packed text file. The first character is escaped
# within texts, so that the pair stands nowhere else.
_MARK, _ESCAPED = "\x1e", "\x1e."
_END = "\x1e\n"


def write_records_json(df: DataFrame, path: str, record: str = "record") -> None:
    """One JSON object per line, with null fields kept and letters as they are."""
    df.select(f"{record}.*").write.option("ignoreNullFields", "false").json(path)


def read_records_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_documents_text(
    df: DataFrame, path: str, doc: str = "doc_id", text: str = "text", *, file_each: bool = False
) -> None:
    """Document texts as UTF-8.

    Packed files by default, many documents in each: a file per document would
    be too many for a corpus. ``file_each`` writes ``<doc>=<id>/`` folders with
    one file each, for a selection meant to be opened one by one.
    """
    if file_each:
        df.select(doc, text).write.partitionBy(doc).option("lineSep", "\n").text(path)
        return
    body = F.replace(F.col(text), F.lit(_MARK), F.lit(_ESCAPED))
    key = F.replace(F.col(doc).cast("string"), F.lit(_MARK), F.lit(_ESCAPED))
    # The id stands on the first line, so it must have no line break itself.
    row = F.concat_ws("\n", F.when(key.contains("\n"), F.raise_error(F.lit("line break in id"))).otherwise(key), body)
    df.select(row.alias("value")).write.option("lineSep", _END).text(path)


def read_documents_text(spark: SparkSession, path: str, doc: str = "doc_id", *, file_each: bool = False) -> DataFrame:
    """(``doc``, text) of what ``write_documents_text`` wrote."""
    if file_each:
        whole = spark.read.text(path, wholetext=True)
        # The writer ends the file with a line break of its own.
        return whole.select(doc, F.substr("value", F.lit(1), F.length("value") - 1).alias("text"))
    raw = spark.read.option("lineSep", _END).text(path)
    value = F.replace(F.col("value"), F.lit(_ESCAPED), F.lit(_MARK))
    key = F.substring_index(value, "\n", 1)
    # A null text has no line break behind the id.
    text = F.when(value.contains("\n"), F.substr(value, F.length(key) + 2))
    return raw.select(key.alias(doc), text.alias("text"))
