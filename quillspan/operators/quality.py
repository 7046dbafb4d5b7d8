"""Data-quality reports over chunk metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

REQUIRED = ("chunk_id", "source_id", "source_type", "jurisdiction", "text", "citation", "indexed_at")
OPTIONAL = ("title", "category", "last_updated")
SOURCE_TYPES = ("federal", "state", "county", "municipal")


def has(col: str) -> Column:
    """Neither null nor empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit("")) != ""


def floor_percentiles(rows: DataFrame, value: str, points: Sequence[int] = (50, 95, 99), by: Sequence[str] = ()) -> DataFrame:
    """sorted[min(floor(n * p / 100), n - 1)] for each point, exactly.

    Rows are counted by value before anything is ordered, so a task sees at most the distinct values of its group.
    """
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*by)
    upto = F.sum("_n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumns({"_upto": upto, "_all": F.sum("_n").over(w)})
    at = lambda p: F.least(F.floor(F.col("_all") * p / 100), F.col("_all") - 1)
    pick = lambda p: F.min(F.when(F.col("_upto") > at(p), F.col(value)))
    return ranked.groupBy(*by).agg(*[pick(p).alias(f"p{p}") for p in points])


def distribution(rows: DataFrame, value: str = "tokens", by: Sequence[str] = ()) -> DataFrame:
    """min, max, rounded mean, floor percentiles and count."""
    base = rows.groupBy(*by).agg(F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.avg(value)).cast("long").alias("avg"), F.count(F.lit(1)).alias("count"))
    points = floor_percentiles(rows, value, by=by)
    if by:
        return base.join(points, list(by))
    return base.join(F.broadcast(points))  # one row each


def distribution_summary(found: DataFrame) -> DataFrame:
    """Adds `summary`, one line of text, to the rows of distribution()."""
    return found.withColumn("summary", F.format_string("Tokens: avg=%d, range=[%d-%d], p95=%d", "avg", "min", "max", "p95"))


def outliers(rows: DataFrame, value: str = "tokens", threshold: float = 2.0) -> DataFrame:
    """Rows more than `threshold` population deviations from the mean."""
    m = rows.agg(F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sd"))
    z = F.abs(F.col(value) - F.col("_mean")) / F.col("_sd")
    return rows.join(F.broadcast(m)).where("_sd > 0").withColumn("deviation", F.round(z, 6)).where(z > threshold).drop("_mean", "_sd")


def limit_violations(rows: DataFrame, value: str = "tokens", soft: int = 1500, hard: int = 8192) -> DataFrame:
    return rows.where(F.col(value) > soft).withColumn("severity", F.when(F.col(value) > hard, "hard").otherwise("soft"))


def validate(rows: DataFrame, required: Sequence[str] = REQUIRED, optional: Sequence[str] = OPTIONAL) -> DataFrame:
    """Adds missing (required fields without a value), absent (optional ones) and is_valid."""
    lack = lambda names: F.filter(F.array(*[F.when(~has(c), F.lit(c)) for c in names]), lambda x: x.isNotNull())
    return rows.withColumns({"missing": lack(required), "absent": lack(optional)}).withColumn("is_valid", F.size("missing") == 0)


def report(rows: DataFrame, *by: str) -> DataFrame:
    """Counts and coverages by source type, from one scan; the averages stay rounded as the second level expects."""
    n = F.count(F.lit(1))
    share = lambda c: F.round(F.count_if(has(c)) / n * 100, 1)
    return rows.groupBy(*by).agg(
        n.alias("chunks"), F.round(F.avg("tokens")).cast("long").alias("avg_tokens"), F.max("tokens").alias("max_tokens"),
        share("citation").alias("citation_coverage"), share("title").alias("title_coverage"), share("category").alias("category_coverage"), F.count_if(~has("citation")).alias("missing_citations"),
    )


def full_report(by_type: DataFrame) -> DataFrame:
    """Second level over report(): the average weighs the already rounded averages; coverage is of the four source types."""
    return by_type.agg(
        F.sum("chunks").alias("chunks"), F.round(F.sum(F.col("chunks") * F.col("avg_tokens")) / F.sum("chunks")).cast("long").alias("avg_tokens"),
        F.round(F.count_if(F.col("chunks") > 0) / len(SOURCE_TYPES) * 100, 1).alias("source_coverage"),
        (F.coalesce(F.sum("chunks"), F.lit(0)) > 0).alias("has_chunks"), (F.sum("missing_citations") == 0).alias("success"),
    )


def source_distribution(rows: DataFrame, col: str = "source_type") -> DataFrame:
    """One row with a count for each of the four source types, zero included."""
    return rows.agg(*[F.count_if(F.col(col) == s).alias(s) for s in SOURCE_TYPES])


def markdown(rows: list[dict], title: str) -> str:
    """A small table for people, made on the driver from a report's few rows."""
    if not rows:
        return f"# {title}\n\nNo rows.\n"
    names = list(rows[0])
    lines = ["| " + " | ".join(names) + " |", "|" + "---|" * len(names)]
    return "\n".join([f"# {title}", "", *lines, *("| " + " | ".join(str(r[n]) for n in names) + " |" for r in rows)]) + "\n"


def _table(names: tuple[str, ...], rows: list[tuple]) -> list[str]:
    return ["| " + " | ".join(names) + " |", "|" + "|".join("-" * (len(n) + 2) for n in names) + "|", *("| " + " | ".join(map(str, r)) + " |" for r in rows)]


# Fixed values in the two reports: their headings, labels and order.


def quality_markdown(report: dict, issues: list[tuple[str, str]], made: str) -> str:
    """A source's quality as a page of sections. report: jurisdiction, source_type, chunks, citation_coverage, the token
    figures avg, min, max, p50, p95 and p99, and has_category, has_title and has_last_updated; issues: chunk id and issue."""
    total = report["chunks"]
    share = lambda n: f"{n / total * 100:.1f}%" if total else "0.0%"
    figures = (("Average", "avg"), ("Minimum", "min"), ("Maximum", "max"), ("Median (p50)", "p50"), ("95th Percentile", "p95"), ("99th Percentile", "p99"))
    fields = (("Category", "has_category"), ("Title", "has_title"), ("Last Updated", "has_last_updated"))
    parts = [
        [f"# Data Quality Report: {report['jurisdiction']} ({report['source_type']})"], [f"**Generated:** {made}"], ["## Summary"],
        [f"- **Total Chunks:** {total}", f"- **Citation Coverage:** {report['citation_coverage']}%", f"- **Issues Found:** {len(issues)}"],
        ["## Token Distribution"], _table(("Metric", "Value"), [(name, report[key]) for name, key in figures]),
        ["## Metadata Completeness"], _table(("Field", "Count", "Percentage"), [(name, report[key], share(report[key])) for name, key in fields]),
        ["## Issues"], _table(("Chunk ID", "Issue"), issues) if issues else ["No validation issues found."],
    ]
    return "\n\n".join("\n".join(p) for p in parts) + "\n"


def coverage_markdown(kind: str, plural: str, key: str, enabled: list[dict], skipped: list[dict], made: str) -> str:
    """Sources' coverage as a page of sections. enabled: name, key, platform, status (active, error or pending), sections,
    vectors and error; skipped: name, key and reason."""
    failed = [r for r in enabled if r["status"] == "error"]
    count = lambda c: sum(r.get(c) or 0 for r in enabled)
    figures = [
        (f"Target {plural}", len(enabled) + len(skipped)), (f"Enabled {plural}", len(enabled)), (f"Skipped {plural}", len(skipped)),
        (f"Processed {plural}", sum(r["status"] == "active" for r in enabled)), (f"Failed {plural}", len(failed)), ("Total Ordinances", count("sections")), ("Total Vectors", count("vectors")),
    ]
    dash = lambda v: "-" if v is None else v
    rows = [(r["name"], r[key], r["platform"], r["status"], dash(r.get("sections")), dash(r.get("vectors"))) for r in enabled]
    parts = [
        [f"# Texas {kind} Coverage Report"], [f"Generated: {made}"], ["## Summary"], _table(("Metric", "Count"), figures),
        [f"## Enabled {plural}"], _table((kind, key.upper(), "Platform", "Status", "Ordinances", "Vectors"), rows),
        [f"## Skipped {plural}"], _table((kind, key.upper(), "Reason"), [(r["name"], r[key], r["reason"]) for r in skipped]) if skipped else [f"None - all target {plural.lower()} enabled."],
    ]
    if failed:
        parts += [[f"## Failed {plural}"], _table((kind, key.upper(), "Error"), [(r["name"], r[key], r.get("error") or "Unknown error") for r in failed])]
    return "\n\n".join("\n".join(p) for p in parts) + "\n"
