"""PDF scan (SRC-08, SRC-09, SRC-11 to SRC-14): pages, glyphs and paths as rows, if a PDF library is installed.

The library is optional: without it the layout operators take their tables from
elsewhere, and reading fails with a message. A file is one task's row; its pages
are read one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

GLYPHS = "doc string, page int, char int, ch string, x0 double, y0 double, x1 double, y1 double"
PATHS = "doc string, page int, path int, kind string, x0 double, y0 double, x1 double, y1 double"
PAGES = "doc string, page int, width double, height double, rotation int, producer string, pages int"


def available() -> bool:
    try:
        import pypdfium2  # noqa: F401
    except ImportError:
        return False
    return True


def _scan(spark: SparkSession, path: str, schema: str, rows_of, pages: tuple[int, ...] | None) -> DataFrame:
    if not available():
        raise ModuleNotFoundError("reading PDF needs pypdfium2")
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pypdfium2

        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pdf = pypdfium2.PdfDocument(content)
                for n in range(len(pdf)) if pages is None else [p for p in pages if 0 <= p < len(pdf)]:
                    rows = [(file, n, *r) for r in rows_of(pdf, pdf[n])]
                    if rows:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def read_glyphs(spark: SparkSession, path: str, pages: tuple[int, ...] | None = None) -> DataFrame:
    """Characters with their boxes, in the page's order."""

    def glyphs(_, page):
        text = page.get_textpage()
        for i in range(text.count_chars()):
            x0, y0, x1, y1 = text.get_charbox(i)
            yield i, text.get_text_range(i, 1), x0, y0, x1, y1

    return _scan(spark, path, GLYPHS, glyphs, pages)


def read_paths(spark: SparkSession, path: str, pages: tuple[int, ...] | None = None) -> DataFrame:
    """Paths and images with their boxes."""

    def objects(_, page):
        from pypdfium2 import raw

        kinds = {raw.FPDF_PAGEOBJ_PATH: "path", raw.FPDF_PAGEOBJ_IMAGE: "image"}
        for i, o in enumerate(page.get_objects(filter=list(kinds))):
            x0, y0, x1, y1 = o.get_pos()
            yield i, kinds[o.type], x0, y0, x1, y1

    return _scan(spark, path, PATHS, objects, pages)


def read_pages(spark: SparkSession, path: str, pages: tuple[int, ...] | None = None) -> DataFrame:
    """Sizes of pages, and what made the document; numbers out of range are skipped."""

    def sizes(pdf, page):
        width, height = page.get_size()
        yield width, height, page.get_rotation(), pdf.get_metadata_dict().get("Producer", ""), len(pdf)

    return _scan(spark, path, PAGES, sizes, pages)
