"""Members of archives as rows, and files compressed by themselves (SRC-06, SRC-07)."""

from __future__ import annotations

import io
import lzma
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datasheaf.operators.windows import version_key

MEMBER = "path string, member string, content binary"


def read_zip(spark: SparkSession, path: str, prefixes: tuple[str, ...] = (), pattern: str = "") -> DataFrame:
    """(path, member, content) of zip (or jar) files: members under one of the prefixes, whose name the pattern is found in. A file that is no archive has no members."""
    wanted = re.compile(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content or b""))
                except zipfile.BadZipFile:
                    continue
                for name in archive.namelist():  # one member at a time: an archive may hold more than it weighs
                    if not name.endswith("/") and (not prefixes or name.startswith(prefixes)) and wanted.search(name):
                        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([name]), pa.array([archive.read(name)], pa.binary())], names=["path", "member", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, MEMBER)


def read_lzma(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, content) of files compressed on their own; what can't be read is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    found = lzma.decompress(content or b"")
                except lzma.LZMAError:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([re.sub(r".*/|\.(?:xz|lzma)$", "", file)]), pa.array([found], pa.binary())], names=["path", "member", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, MEMBER)


def text_of(content: Column | str) -> Column:
    """Content as text with plain line ends and no blanks before them."""
    return F.regexp_replace(F.decode(content, "utf-8"), r"[ \t\r]+(?=\n|\z)", "")


def newest(versions: DataFrame, version: str = "version", by: tuple[str, ...] = ()) -> DataFrame:
    """The row with the highest version, compared number by number."""
    return versions.groupBy(*by).agg(F.max_by(F.struct("*"), version_key(F.col(version))).alias("__row")).select("__row.*")
