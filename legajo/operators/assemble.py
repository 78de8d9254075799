"""Documents from their pages or paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions.patterns import SPACE


def _assemble(df: DataFrame, doc: str, ord: str, text: str, keep: Column) -> DataFrame:
    parts = df.select(
        F.col(doc).alias("_doc"), F.col(ord).alias("_ord"), F.when(keep, F.col(text)).alias("_text")
    )
    item = F.when(F.col("_text").isNotNull(), F.struct("_ord", "_text"))
    ordered = F.array_sort(F.collect_list(item))
    joined = F.array_join(F.transform(ordered, lambda i: i["_text"]), "\n")
    return parts.groupBy(F.col("_doc").alias(doc)).agg(joined.alias("text"))


def assemble_pages(df: DataFrame, doc: str, ord: str, text: str) -> DataFrame:
    """(``doc``, text): the page texts of each document joined in order by a line break.

    One string per document is one row, so a document must fit in the memory of
    a task. For documents that may not, choose ``order_pages``.
    """
    return _assemble(df, doc, ord, text, F.lit(True))


def assemble_paragraphs(df: DataFrame, doc: str, ord: str, text: str) -> DataFrame:
    """As ``assemble_pages``, leaving out blank paragraphs.

    Kept ones are not stripped. A document with blank ones only gives ``""``.
    """
    return _assemble(df, doc, ord, text, F.rlike(F.col(text), F.lit(rf"[^{SPACE}]")))


def order_pages(df: DataFrame, doc: str, ord: str) -> DataFrame:
    """The rows of ``df`` with each document's pages next to each other, in order.

    Sorted by ranges of document and page, so that a document of any size is
    spread over as many tasks as it needs.
    """
    order = [F.col(doc), F.col(ord)]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)
