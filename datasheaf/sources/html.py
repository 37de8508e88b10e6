"""HTML scan: documents to ordered items (headings, texts, tables), by an event scanner in Arrow batches.

Rules (SRC-15). Captured text keeps inner tags without their attributes; span is
dropped, its content kept; self-closing tags are written out as a pair. A table
element or one of its parts starts a new capture, as does a heading. Otherwise
the first tag met while nothing is open becomes a text, which ends with that
tag. So what stands before the first heading or table, inside one outer
element, is lost to it, and a page with neither is one text. Line breaks inside
are removed and ends trimmed. A table of one cell ``(omitted)`` is dropped.
Void elements are closed by themselves, and end tags without a start ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELL = pa.struct([("row", pa.int32()), ("xspan", pa.int32()), ("yspan", pa.int32()), ("is_header", pa.bool_()), ("html", pa.string())])
ITEM = [("item_no", pa.int32()), ("kind", pa.string()), ("html", pa.string()), ("heading", pa.string()), ("caption", pa.string()), ("cells", pa.list_(CELL))]
ITEM_DDL = "item_no int, kind string, html string, heading string, caption string, cells array<struct<row: int, xspan: int, yspan: int, is_header: boolean, html: string>>"


def _span(attrs: dict[str, str | None], name: str) -> int:
    value = (attrs.get(name) or "").strip()
    return max(1, int(value)) if value.isdigit() else 1


class ItemScanner(HTMLParser):
    """Collects (kind, html, heading, caption, cells)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[tuple[str, str, str | None, str | None, list[dict] | None]] = []
        self.open: list[str] = []
        self.kind: str | None = None
        self.text_depth = 0
        self.buffer: list[str] | None = None
        self.heading: str | None = None
        self.table: dict | None = None
        self.part: dict | None = None

    def _captured(self) -> str:
        out = "".join(self.buffer or []).replace("\n", "").replace("\r", "").strip()
        self.buffer = None
        return out

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.open.append(tag)
        if tag == "table":
            self.kind, self.buffer = "table", None
            self.table = {"row": -1, "caption": "", "cells": []}
        elif self.table is not None and tag == "tr":
            self._end_part()
            self.table["row"] += 1
        elif self.table is not None and tag in ("td", "th", "caption"):
            self._end_part()
            a = dict(attrs)
            self.part = {"tag": tag, "row": max(0, self.table["row"]), "xspan": _span(a, "colspan"), "yspan": _span(a, "rowspan"), "is_header": tag == "th"}
            self.buffer = []
        elif tag in HEADINGS and self.table is None:
            self.kind, self.buffer = "heading", []
        elif tag != "span":
            if self.kind is None:
                self.kind, self.buffer, self.text_depth = "text", [], len(self.open)
            elif self.buffer is not None:
                self.buffer.append(f"<{tag}>")
        if tag in VOID:
            self.handle_endtag(tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in self.open:
            return
        depth = len(self.open)
        while self.open.pop() != tag:
            depth -= 1
        if self.table is not None:
            if tag == "table":
                self._end_table()
            elif self.part is not None and tag == self.part["tag"]:
                self._end_part()
            elif self.buffer is not None and tag != "span":
                self.buffer.append(f"</{tag}>")
        elif self.kind == "heading" and tag in HEADINGS:
            self.heading = self._captured()
            self.items.append(("heading", self.heading, None, None, None))
            self.kind = None
        elif self.kind == "text" and depth <= self.text_depth:
            self.items.append(("text", self._captured(), self.heading, None, None))
            self.kind = None
        elif self.buffer is not None and tag != "span":
            self.buffer.append(f"</{tag}>")

    def _end_part(self) -> None:
        """Keep the open cell or caption; one that is never closed ends where the next starts."""
        if self.part is not None and self.buffer is not None:
            text = self._captured()
            if self.part["tag"] == "caption":
                self.table["caption"] = text
            else:
                self.table["cells"].append({k: self.part[k] for k in ("row", "xspan", "yspan", "is_header")} | {"html": text})
        self.part = self.buffer = None

    def _end_table(self) -> None:
        self._end_part()
        cells, caption = self.table["cells"], self.table["caption"]
        if cells and not (len(cells) == 1 and cells[0]["html"] == "(omitted)"):
            self.items.append(("table", "", self.heading, caption, cells))
        self.kind = self.buffer = self.table = self.part = None

    def handle_data(self, data: str) -> None:
        if self.buffer is not None:
            self.buffer.append(data)


def scan(page: str) -> list[tuple]:
    scanner = ItemScanner()
    scanner.feed(page)
    scanner.close()
    return scanner.items


def items(pages: DataFrame) -> DataFrame:
    """``pages`` (doc, chapter, html) to (doc, chapter, item_no, kind, html, heading, caption, cells). A null page has no items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, chapters, pages_ = (batch.column(i).to_pylist() for i in range(3))
            rows = [(d, c, n, *item) for d, c, page in zip(docs, chapters, pages_, strict=True) for n, item in enumerate(scan(page or ""))]
            columns = list(zip(*rows, strict=True)) if rows else [()] * (2 + len(ITEM))
            kinds = [pa.string(), pa.string(), *(t for _, t in ITEM)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=["doc", "chapter", *(n for n, _ in ITEM)])

    return pages.select(F.col("doc").cast("string"), F.col("chapter").cast("string"), "html").mapInArrow(run, f"doc string, chapter string, {ITEM_DDL}")


def file_parts(path: Column) -> dict[str, Column]:
    """Document, version, chapter and its number from a path such as .../NAME-v3/chapter_12_title.html (SRC-16, SRC-17)."""
    folder, stem = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1), F.regexp_extract(path, r"([^/]+)\.html?$", 1)
    return {
        "doc": F.regexp_extract(folder, r"^(.*?)(?:-([^-]*))?$", 1),
        "version": F.regexp_extract(folder, r"-([^-]*)$", 1),
        "chapter": F.replace(stem, F.lit("_"), F.lit(" ")),
        "number": F.try_element_at(F.split(stem, "_"), F.lit(2)),
    }


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """(doc, version, chapter, number, html) of the HTML files below a folder; a file is one row."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html").select("value", F.col("_metadata.file_path").alias("path"))
    return files.select(*[c.alias(n) for n, c in file_parts(F.col("path")).items()], F.col("value").alias("html"))
