"""Object-store style readers and writers over any file system that Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspan.functions.text import content_type


def documents(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """key (the path below root), content, size, stored_at and content_type of the files under root; only the listing is read unless content is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    top = _qualified(spark, root).toString().rstrip("/") + "/"
    key = F.when(F.col("path").startswith(top), F.substring("path", F.lit(len(top) + 1), F.length("path"))).otherwise(F.col("path"))
    return files.select("path", key.alias("key"), F.col("content").cast("string").alias("content"), F.col("length").alias("size"), F.col("modificationTime").alias("stored_at"), content_type(F.col("path")).alias("content_type"))


def _qualified(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at)  # noqa: SLF001


def delete(spark: SparkSession, root: str, key: str) -> bool:
    """Remove one object; whether there was one."""
    at = _qualified(spark, f"{root.rstrip('/')}/{key}")
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, False))  # noqa: SLF001


def point(spark: SparkSession, path: str, **where) -> DataFrame:
    """Rows of a stored table with these values of its partition columns: other folders aren't read."""
    rows = spark.read.parquet(path)
    for name, value in where.items():
        rows = rows.where(F.col(name) == value)
    return rows


def listed(files: DataFrame, pattern: str, number: bool = True) -> DataFrame:
    """Ids that a pattern takes from paths, numbers in their order before other texts."""
    found = files.select(F.regexp_extract("path", pattern, 1).alias("id")).where("id <> ''").distinct()
    return found.orderBy(*([F.asc_nulls_last(F.expr("try_cast(id as double)"))] if number else []), "id")


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON manifest; broken lines give nulls, a missing file no rows."""
    try:
        return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def store(rows: DataFrame, path: str, *by: str, mode: str = "append") -> None:
    """Write with audit columns, partitioned so that point reads prune."""
    rows.withColumns({"stored_at": F.current_timestamp(), "content_length": F.octet_length("text")}).write.mode(mode).partitionBy(*by).parquet(path)


def storage_stats(files: DataFrame, *by: str) -> DataFrame:
    return files.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
