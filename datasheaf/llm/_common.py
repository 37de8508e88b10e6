"""What the operators share: the shared staging folder, null-safe keys, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: blank, and TAB to CR.
SPACE = r"[\x20\x09-\x0D]+"

_OWN_FOLDER: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a session on this machine alone may leave it unset, and gets a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN_FOLDER:
        _OWN_FOLDER.append("file://" + tempfile.mkdtemp(prefix="datasheaf-"))
    return _OWN_FOLDER[0]


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and pins the values of
    expressions that depend on row order (generated names, random draws).
    """
    path = f"{staging_root(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; the same on all executors. DATASHEAF_TOKENIZERS names another folder."""
    if folder := os.environ.get("DATASHEAF_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` can use it often while it is computed once a row."""
    return F.transform(F.array(value), body)[0]


def per_row(df: DataFrame, keep: list[Column], text: Column, fn: Callable, schema: str) -> DataFrame:
    """Map whole texts in Arrow batches: ``fn(list of bytes) -> list of columns``, put after the ``keep`` columns.

    ``fn`` gets the UTF-8 bytes of each text; texts are never cut.
    """
    names = [f.name for f in df.select(*keep).schema]
    out = f"{df.select(*keep)._jdf.schema().toDDL()}, {schema}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # slices bound what Python holds beside the batch itself
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                made = fn(part.column(len(names)).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *made], names=[*names, *new])

    new = [x.strip().split(" ")[0] for x in schema.split(",")]
    return df.select(*keep, F.coalesce(text, F.lit("")).cast("binary").alias("__text")).mapInArrow(run, out)


# ---- arrays of numbers in a binary column --------------------------------------


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers, none negative, by planes of their bytes, compressed."""
    x = np.ascontiguousarray(numbers).astype("<u8")
    n_planes = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    return bytes([n_planes]) + len(x).to_bytes(8, "little") + squeeze(x.view(np.uint8).reshape(-1, 8)[:, :n_planes].T.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    n_planes, n = raw[0], int.from_bytes(raw[1:9], "little")
    x = np.zeros((n, 8), np.uint8)
    x[:, :n_planes] = np.frombuffer(unsqueeze(raw[9:]), np.uint8).reshape(n_planes, n).T
    return x.view("<u8").ravel().view(np.int64)


def pack_steps(numbers: np.ndarray) -> bytes:
    """Signed numbers by their differences, the signs in the last bits: small where numbers rise."""
    steps = np.diff(numbers.astype(np.int64), prepend=0)
    return pack(steps << 1 ^ steps >> 63)


def unpack_steps(raw: bytes) -> np.ndarray:
    steps = unpack(raw)
    return np.cumsum((steps.view(np.uint64) >> np.uint64(1)).view(np.int64) ^ -(steps & 1))
