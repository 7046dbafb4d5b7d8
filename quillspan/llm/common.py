"""Helpers shared by the operators: stage tables in the shared folder and Arrow text access."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

#: XXH64 seed of Spark's xxhash64() and of every shingle hash here.
SEED = 42
#: A-Z to a-z and nothing else.
ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: A word in Java's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or for a local session without one a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quillspan-"))
    return sc.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    This cuts the lineage at a replicated or at least shared table, so a lost executor costs only its own tasks, and it
    keeps a result that several later steps use from being computed several times.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillspan/{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path  # noqa: SLF001
    return out


def discard(df: DataFrame) -> None:
    """Remove a table that materialise() wrote and nothing reads any more."""
    path = getattr(df, "_stage_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where.getParent(), True)


def row_key(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes over all columns: equal for equal rows, and for others but for a chance of about 2 ** -128 a pair.

    Nulls are told apart by their place; nested values are hashed as JSON with their nulls.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        nested = isinstance(f.dataType, (ArrayType, MapType, StructType))
        parts += [c.isNull(), F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if nested else c]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_string())
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(at: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes, or of one row if that is larger."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


@contextlib.contextmanager
def rows_a_batch(spark: SparkSession, n: int) -> Iterator[None]:
    """At most n rows in each Arrow batch of what runs inside; buffers of long texts stay small on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)
