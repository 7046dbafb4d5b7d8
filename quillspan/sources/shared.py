"""The folder that driver and executors share: stage tables, stores and checkpoints of a run."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new path under spark.checkpoint.dir; a local session without that setting gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quillspan-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/quillspan/{uuid.uuid4().hex}/{label}"


def kept(rows: DataFrame, label: str) -> DataFrame:
    """rows as a table in the shared folder, so that later steps read one result."""
    path = folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
