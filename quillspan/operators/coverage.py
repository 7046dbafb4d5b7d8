"""Coverage of what should be indexed: left joins to registries, gaps and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def indexed(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("jurisdiction").agg(F.count(F.lit(1)).alias("vectors"))


def flags(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Expected sources with their vector count and whether they are indexed."""
    return expected.join(found, "jurisdiction", "left").withColumns({"vectors": F.coalesce("vectors", F.lit(0)), "is_indexed": F.col("vectors").isNotNull()})


def by_source(flagged: DataFrame) -> DataFrame:
    n, k = F.count(F.lit(1)), F.count_if("is_indexed")
    return flagged.groupBy("source_type").agg(n.alias("expected"), k.alias("indexed"), F.round(k / n * 100, 2).alias("percentage"))


def gaps(expected: DataFrame, found: DataFrame) -> DataFrame:
    return expected.join(found, "jurisdiction", "left_anti").withColumn("reason", F.concat(F.lit("No vectors indexed for "), "name"))


def summary(rows: DataFrame, target: Column | int) -> DataFrame:
    """Counts by status, whole percentages; what has no row yet is pending."""
    t = F.lit(target) if isinstance(target, int) else target
    active, error = F.count_if(F.col("status") == "active"), F.count_if(F.col("status") == "error")
    return rows.agg(active.alias("active"), error.alias("errors"), (t - F.count(F.lit(1)) + F.count_if(F.col("status") == "pending")).alias("pending"), F.coalesce(F.sum("vectors"), F.lit(0)).alias("vectors"), F.round(active / t * 100).cast("long").alias("percentage"))


def missing_storage(jurisdictions: DataFrame, keys: DataFrame) -> DataFrame:
    """Jurisdictions without any stored key under their prefix.

    The prefix's first two parts are an equality key, so that this is a hash anti-join and not a comparison of all pairs.
    """
    from quillspan.functions.text import storage_prefix

    want = jurisdictions.withColumn("prefix", storage_prefix(F.col("jurisdiction")))
    parts = F.split("key", "/")
    head = F.when(parts[0].isin("federal", "texas"), F.concat(parts[0], F.lit("/"))).otherwise(F.concat(parts[0], F.lit("/"), parts[1], F.lit("/")))
    return want.join(keys.select(head.alias("prefix")).distinct(), "prefix", "left_anti")


def sync_issues(expected: DataFrame, actual: DataFrame, key: str, tolerance: float = 0.1) -> DataFrame:
    """Missing, stale and mismatched counts between two tables with a column vectors."""
    a, b = expected.select(key, F.col("vectors").alias("want")), actual.select(key, F.col("vectors").alias("have"))
    issue = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "stale").when(F.abs(F.col("want") - F.col("have")) > tolerance * F.col("want"), "mismatch")
    return a.join(b, key, "full_outer").withColumn("issue", issue).where("issue is not null")
