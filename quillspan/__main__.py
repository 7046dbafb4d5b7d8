"""Validate an index table: python -m quillspan CHUNKS [--format json|markdown] [--coverage-only] [--output FILE]."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillspan.functions.text import tokens
from quillspan.operators import coverage as V, quality as Q
from quillspan.plans import registry


def rows(df: DataFrame) -> list[dict]:
    """For reports of a few rows."""
    return [r.asDict() for r in df.collect()]


def validate(spark: SparkSession, chunks: DataFrame, coverage_only: bool = False) -> dict[str, list[dict]]:
    """Report tables by title."""
    expected, found = registry.expected_jurisdictions(spark), V.indexed(chunks)
    out = {"Coverage": rows(V.by_source(V.flags(expected, found)).orderBy("source_type")), "Gaps": rows(V.gaps(expected, found).orderBy("source_type", "name"))}
    if not coverage_only:
        if "tokens" not in chunks.columns:
            chunks = chunks.withColumn("tokens", tokens(F.col("text")))
        by_type = Q.report(chunks, "source_type")
        out |= {"Quality": rows(by_type.orderBy("source_type")), "Total": rows(Q.full_report(by_type))}
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="quillspan", description=__doc__)
    p.add_argument("chunks", help="Parquet table with source_type, jurisdiction, citation, title, category and text or tokens")
    p.add_argument("--format", choices=("json", "markdown"), default="markdown")
    p.add_argument("--coverage-only", action="store_true")
    p.add_argument("--output")
    args = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    found = validate(spark, spark.read.parquet(args.chunks), args.coverage_only)
    text = json.dumps(found, indent=2, default=str) if args.format == "json" else "\n".join(Q.markdown(r, t) for t, r in found.items())
    if args.output:
        Path(args.output).write_text(text, encoding="utf-8")
    else:
        print(text)
    return 0 if args.coverage_only or all(r["success"] for r in found["Total"]) else 1


if __name__ == "__main__":
    sys.exit(main())
