"""Text of DOCX and PDF bytes, read in Arrow batches.

The one place with Python per document: both formats need a codec Spark has
not. Only such files' bytes are sent to Python workers.
"""

from __future__ import annotations

import importlib.util
import io
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from legajo.functions.patterns import SPACE

_NS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
# Run content that stands for a character.
_MARKS = {"tab": "\t", "ptab": "\t", "cr": "\n", "noBreakHyphen": "-"}


def _run_text(run: ElementTree.Element) -> str:
    out = []
    for node in run:
        name = node.tag.removeprefix(_NS)
        if name == "t":
            out.append(node.text or "")
        elif name == "br":
            # Page and column breaks leave no character.
            out.append("\n" if node.get(f"{_NS}type", "textWrapping") == "textWrapping" else "")
        else:
            out.append(_MARKS.get(name, ""))
    return "".join(out)


def _paragraphs(content: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        body = ElementTree.fromstring(package.read("word/document.xml")).find(f"{_NS}body")
    texts = []
    for paragraph in body.findall(f"{_NS}p"):
        runs = (
            run
            for node in paragraph
            for run in ([node] if node.tag == f"{_NS}r" else node.findall(f"{_NS}r") if node.tag == f"{_NS}hyperlink" else [])
        )
        texts.append("".join(map(_run_text, runs)))
    return texts


def _pages(content: bytes) -> list[str]:
    import pymupdf

    with pymupdf.open(stream=content, filetype="pdf") as document:
        return [page.get_text("text") for page in document]


def _reader(read: Callable[[bytes], list[str]]):
    """An Arrow-batched function; null for null and for bytes it cannot read."""

    def parts(content: pd.Series) -> pd.Series:
        def one(data):
            if data is None:
                return None
            try:
                return read(bytes(data))
            except ImportError:
                # A worker without the library says nothing about the file.
                raise
            except Exception:
                return None

        return content.map(one)

    return F.pandas_udf(parts, "array<string>")


def docx_paragraphs(content: Column) -> Column:
    """Texts of the body paragraphs in order, blank ones included."""
    return _reader(_paragraphs)(content)


def has_pdf_reader() -> bool:
    return importlib.util.find_spec("pymupdf") is not None


def pdf_pages(content: Column) -> Column:
    """Page texts in order; needs the ``pymupdf`` package on every worker."""
    return _reader(_pages)(content)


def join_pages(pages: Column) -> Column:
    return F.array_join(pages, "\n")


def join_paragraphs(paragraphs: Column) -> Column:
    """Joined by line breaks without the blank ones."""
    return F.array_join(
        F.filter(paragraphs, lambda p: F.rlike(p, F.lit(rf"[^{SPACE}]"))), "\n"
    )
