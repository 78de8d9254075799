"""The per-file calls as a stream: each new file gives its record once.

The job is the batch job: it is narrow, so it needs no state and no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from legajo.plans.folder import cv_records_of, texts
from legajo.sources import files

_FILE = "path string, modificationTime timestamp, length long, content binary"


def arriving_documents(spark: SparkSession, folder: str, files_per_batch: int = 10_000) -> DataFrame:
    """A stream with the columns of ``scan_documents``."""
    found = (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return files.with_name_parts(found.select("path", "content"))


def cv_record_stream(spark: SparkSession, folder: str, salt: str, checkpoint: str) -> DataStreamWriter:
    """A writer of (path, record, errors) rows: choose its format, then start it."""
    built = cv_records_of(texts(arriving_documents(spark, folder)), salt)
    return built.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
