"""Page sources: pages(pdf_id, page_no, text) and page tables.

Pages are ordinary tables; ``pdf_pages`` reads PDF files where a parser
(pdfplumber) is installed.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

try:
    import pdfplumber
except ImportError:
    pdfplumber = None

PAGES = "pdf_id string, page_no int, text string"
PAGE_TABLES = "pdf_id string, page_no int, table_ix int, rows array<array<string>>"


def open_pdf(content: bytes):
    """A parsed file: a context with ``pages``, each with ``extract_text`` and ``extract_tables``."""
    return pdfplumber.open(io.BytesIO(content))


#: What opens a PDF file; another parser may take its place.
parser = open_pdf


def _files(spark: SparkSession, path: str) -> DataFrame:
    if parser is open_pdf and pdfplumber is None:
        raise RuntimeError("reading PDF files needs pdfplumber; give a table of pages instead")
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _each_page(spark: SparkSession, path: str, book: str | None, rows, schema: str) -> DataFrame:
    """``rows(page)`` of every page, from page 1; one task reads whole files.

    ``book`` names the file; several files go by their paths.
    """
    opened = parser

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                with opened(content) as pdf:
                    yield pd.DataFrame([(book or name, i, *row) for i, p in enumerate(pdf.pages, 1) for row in rows(p)], columns=[c.split()[0] for c in schema.split(", ")])

    return _files(spark, path).mapInPandas(run, schema)


def pdf_pages(spark: SparkSession, path: str, book: str | None = None) -> DataFrame:
    """Text of every page."""
    return _each_page(spark, path, book, lambda p: [(p.extract_text() or "",)], PAGES)


def pdf_tables(spark: SparkSession, path: str, book: str | None = None) -> DataFrame:
    """Tables of every page."""
    return _each_page(spark, path, book, lambda p: list(enumerate(p.extract_tables() or [])), PAGE_TABLES)


def read_pages(spark: SparkSession, path: str, book: str | None = None) -> DataFrame:
    """A Parquet or JSON table of pages, or a PDF file that goes by the name ``book``, by the path's ending."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith((".json", ".jsonl")):
        return spark.read.schema(PAGES).json(path)
    return pdf_pages(spark, path, book)


def read_tables(spark: SparkSession, path: str, book: str | None = None) -> DataFrame:
    """``read_pages`` for the tables on the pages."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith((".json", ".jsonl")):
        return spark.read.schema(PAGE_TABLES).json(path)
    return pdf_tables(spark, path, book)
