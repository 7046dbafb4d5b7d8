"""Incremental ingest: new files are chunked and upserted as they come; a trigger takes what is there and stops."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillspan.operators import chunk as C
from quillspan.operators.store import changed, last_write

#: Hash buckets that a stream's keys are held in, and rows that are given back at once. How keys are written as texts.
BUCKETS, ROWS = 1024, 1000
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_sections(spark: SparkSession, path: str, schema: str | T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the files under path, with `arrived`: their time and name and the row's place, which put versions in order."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.select("*", F.struct("_metadata.file_modification_time", "_metadata.file_name", "_metadata.row_index").alias("arrived"))


def ingest(sections: DataFrame, out: str, checkpoint: str, key: str = "doc_id", pattern: str = r"\n+") -> StreamingQuery:
    """Chunk new or changed sections of each batch and append them with the batch number; readers take the last write.

    Of several versions of a key in one batch the one that arrived last counts; without a column `arrived` they have no
    order and the greatest digest counts. What is known are the batches before, so a batch that is repeated after a
    failure gives the same rows again, in the same folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        order = ["arrived"] if "arrived" in batch.columns else ["digest"]
        rows = last_write(batch.withColumn("digest", F.sha2("text", 256)), [key], order).drop("arrived")
        known = _known(batch.sparkSession, out, key, number)
        fresh = rows if known is None else changed(rows, known, [key]).where("state <> 'unchanged'").drop("state")
        C.chunk(fresh, pattern=pattern).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return sections.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def absent(e: Exception) -> bool:
    """Whether a read failed only because nothing has been written yet."""
    return "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e)


def _known(spark: SparkSession, out: str, key: str, number: int) -> DataFrame | None:
    """key and digest of what batches before this one wrote last; three columns of those folders are read."""
    try:
        rows = spark.read.parquet(out)
    except Exception as e:
        if absent(e):
            return None
        raise
    return last_write(rows.where(F.col("batch") < number).select(key, "digest", "batch"), [key], ["batch"])


def current(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """Chunks of each section's last batch."""
    rows = spark.read.parquet(out)
    newest = rows.groupBy(key).agg(F.max("batch").alias("batch"))
    return rows.join(newest, [key, "batch"], "left_semi")


def changed_sections(sections: DataFrame, key: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """A stream's sections (key, text, arrived) that are new or whose text has changed, with digest and version (from 1).

    The state store holds a digest and a number for each key and nothing else, packed by hash buckets of keys: Python is called once
    a bucket and batch, not once a key. A batch costs what it brings and the digests of the buckets that it reaches, however
    much came before, and a batch that is repeated finds the state of the batch before it. Of a key's rows in a batch the
    one that arrived last counts; rows are read one Arrow batch at a time, and a bucket's last texts are held. A null text is a
    text of its own. buckets: fixed for a stream's life, as keys would be sought in other ones.
    """
    order = F.concat(F.format_string("%020d", F.unix_micros("arrived.file_modification_time")), F.lit("/"), F.col("arrived.file_name"), F.lit("/"), F.format_string("%020d", "arrived.row_index"))
    name = F.to_json(F.struct(F.col(key).alias("k")), _EXACT)  # any kind of key as a text, so that none passes pandas as a number
    digest = F.coalesce(F.sha2("text", 256), F.lit("none"))
    rows = sections.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), name.alias("k"), "text", digest.alias("digest"), order.alias("at"))

    def update(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest: dict[str, tuple] = {}
        for frame in frames:
            for k, *row in zip(frame["k"], frame["at"], frame["text"], frame["digest"], strict=True):
                if k not in newest or row[0] > newest[k][0]:
                    newest[k] = row
        held = _unpacked(state.get[0]) if state.exists else {}
        fresh = []
        for k, (_, text, new) in newest.items():
            old, version = held.get(k, (None, 0))
            if new != old:
                held[k] = new, version + 1
                fresh.append((k, text, new, version + 1))
        if fresh:
            state.update((_packed(held),))
        for i in range(0, len(fresh), ROWS):
            yield pd.DataFrame(fresh[i : i + ROWS], columns=["k", "text", "digest", "version"])

    out = rows.groupBy("bucket").applyInPandasWithState(update, "k string, text string, digest string, version long", "held binary", "append", GroupStateTimeout.NoTimeout)
    of = T.StructType([T.StructField("k", sections.schema[key].dataType)])
    return out.select(F.from_json("k", of, _EXACT)["k"].alias(key), "text", "digest", "version")


def _packed(held: dict[str, tuple[str, int]]) -> bytes:
    digests, versions = zip(*held.values(), strict=True)
    digests = [None if d == "none" else bytes.fromhex(d) for d in digests]
    rows = pa.record_batch([pa.array(list(held), pa.string()), pa.array(digests, pa.binary(32)), pa.array(versions, pa.int64())], names=["k", "digest", "version"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as to:
        to.write_batch(rows)
    return out.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> dict[str, tuple[str, int]]:
    rows = pa.ipc.open_stream(raw).read_all()
    k, digest, version = (rows.column(i).to_pylist() for i in range(3))
    return {a: ("none" if d is None else d.hex(), v) for a, d, v in zip(k, digest, version, strict=True)}


def ingest_keyed(sections: DataFrame, out: str, checkpoint: str, key: str = "doc_id", pattern: str = r"\n+") -> StreamingQuery:
    """ingest() with keyed state: chunks of new and changed sections with digest and version, written once by the file sink. latest()
    reads what counts."""
    # The stateful operator's rows pass a filter first: the Arrow function of chunk() takes them in Spark's binary form only.
    rows = C.chunk(changed_sections(sections, key).where("version > 0"), pattern=pattern)
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def latest(spark: SparkSession, out: str, key: str = "doc_id") -> DataFrame:
    """Chunks of each section's last version."""
    rows = spark.read.parquet(out)
    return rows.join(rows.groupBy(key).agg(F.max("version").alias("version")), [key, "version"], "left_semi")
