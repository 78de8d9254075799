"""Folders of documents: scan, choose a reader, decode."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legajo.session import scratch_path

# Which reader a lower-cased suffix asks for; all else is text.
KINDS = {".pdf": "pdf", ".docx": "docx", ".doc": "docx"}

_SUFFIX = r"^.+(\.[^.]+)$"


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def suffix_of(name: Column) -> Column:
    """``.txt`` of ``a.txt``; ``""`` for ``.profile``, ``a`` and ``a.``."""
    return F.regexp_extract(name, _SUFFIX, 1)


def stem_of(name: Column) -> Column:
    return F.substr(name, F.lit(1), F.length(name) - F.length(suffix_of(name)))


def with_name_parts(df: DataFrame, path: str = "path") -> DataFrame:
    """Add name, stem and suffix of ``path``."""
    named = df.withColumn("name", file_name(F.col(path)))
    return named.withColumn("stem", stem_of(F.col("name"))).withColumn(
        "suffix", suffix_of(F.col("name"))
    )


def _store(path: str):
    """The file system of a path as Spark writes it, the path in it, and what stood in front.

    Paths are plain: blanks, ``%`` and ``#`` in them mean themselves.
    """
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    if not mark or scheme == "file":
        return fs.LocalFileSystem(), re.sub("^file:(//)?", "", path), "file:"
    host, _, inner = rest.partition("/")
    store, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{host}/{quote(inner)}")
    # Object stores count the bucket as part of the path.
    return store, root, f"{scheme}://{host if root.startswith('/') else ''}"


def _entries(folder: str, rows: int = 10_000) -> Iterator[pd.DataFrame]:
    """(path, length, is_folder) of what lies in a folder, not below it."""
    from pyarrow import fs

    store, root, head = _store(folder)
    found = store.get_file_info(fs.FileSelector(root, recursive=False))
    for at in range(0, len(found), rows):
        part = found[at : at + rows]
        yield pd.DataFrame(
            {
                "path": [f"{head}{f.path}" for f in part],
                "length": [f.size or 0 for f in part],
                "is_folder": [f.type == fs.FileType.Directory for f in part],
            }
        )


def list_folder(spark: SparkSession, folders: str | list[str]) -> DataFrame:
    """(path, length) of every file below the folders.

    Level by level: all folders of one depth are listed side by side by tasks, and
    each level's listing is a table in the shared folder, so no task and not the driver holds
    more than one folder's entries.
    """
    folders = [folders] if isinstance(folders, str) else folders

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["folder"]:
                yield from _entries(folder)

    level = spark.createDataFrame([(f,) for f in folders], "folder string")
    schema, found = "path string, length long, is_folder boolean", []
    while True:
        place = scratch_path(spark, "listing")
        level.repartition("folder").mapInPandas(walk, schema).write.parquet(place)
        listed = spark.read.schema(schema).parquet(place)
        found.append(listed.filter("not is_folder").select("path", "length"))
        level = listed.filter("is_folder").select(F.col("path").alias("folder"))
        if level.isEmpty():
            return reduce(DataFrame.union, found)


def read_files(manifest: DataFrame, rows: int = 64) -> DataFrame:
    """(path, name, stem, suffix, content) of the files of a manifest with a ``path`` column.

    Tasks open the files, ``rows`` of them at a time; the driver never sees a path. For
    folders of so many small files that listing them is the work.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                out = []
                for path in batch["path"].iloc[at : at + rows]:
                    store, inner, _ = _store(path)
                    with store.open_input_stream(inner) as stream:
                        out.append((path, stream.read()))
                yield pd.DataFrame(out, columns=["path", "content"])

    files = manifest.select("path").mapInPandas(read, "path string, content binary")
    return with_name_parts(files).select("path", "name", "stem", "suffix", "content")


def scan_documents(
    spark: SparkSession,
    folder: str | list[str],
    glob: str | None = None,
    manifest: DataFrame | None = None,
) -> DataFrame:
    """(path, name, stem, suffix, content) of every file below ``folder``.

    Spark reads no row for a file of zero bytes. Give ``manifest``, a table with
    a ``path`` column such as ``list_folder`` makes, to have the files without a
    row added with empty content. ``glob`` is case-sensitive: ``*.[tT][xX][tT]``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(folder).select("path", "content")
    if manifest is not None:
        missing = manifest.select("path").join(files.select("path"), "path", "left_anti")
        empty = missing.withColumn("content", F.lit("").cast("binary"))
        files = files.unionByName(empty)
    return with_name_parts(files).select("path", "name", "stem", "suffix", "content")


def route_by_suffix(df: DataFrame, suffix: str = "suffix") -> DataFrame:
    """Add ``kind``: pdf, docx or text."""
    lowered = F.lower(F.col(suffix))
    kind = F.lit(None).cast("string")
    for known, reader in KINDS.items():
        kind = F.when(lowered == known, reader).otherwise(kind)
    return df.withColumn("kind", F.coalesce(kind, F.lit("text")))


def decode_text(df: DataFrame, content: str = "content") -> DataFrame:
    """Add ``text`` and ``decode_ok``: strict UTF-8 with ``\\n`` line ends.

    Bytes that are not UTF-8 give null and false. A byte-order mark is kept.
    """
    utf8 = F.try_validate_utf8(F.col(content).cast("string"))
    return df.withColumn("text", F.regexp_replace(utf8, "\r\n?", "\n")).withColumn(
        "decode_ok", F.col("text").isNotNull()
    )
