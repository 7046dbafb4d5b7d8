"""Markdown to ordinance sections: lines, then block tokens, with headings carried by a window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspan.functions.text import strip

#: How headings name chapters, sections and parts, and how subsections are marked.
CHAPTER = r"(?i)Chapter\s+([\d.]+)"
SECTION = r"(?i)(?:Sec(?:tion)?\.?\s*)?([\d.-]+)[.:\s-]+\s*(.+)"
PART = r"(?i)(?:Article|Part)\s+([\dIVXLCDM]+)"
FENCE = r"^ {0,3}(?:`{3,}|~{3,})"
BREAK = r"^ {0,3}(?:(?:- *){3,}|(?:\* *){3,}|(?:_ *){3,})$"
INLINE = r"(?i)\(([a-z]|\d+|[ivxlcdm]+)\)\s+([^(]+?)(?=\([a-z\d]|\s*$)"
LINE = r"(?im)^\s*\(([a-z]|\d+)\)\s+(.+)$"


def carry_headings(lines: DataFrame, by: Sequence[str], order: str, *headings: str) -> DataFrame:
    """Each line gets the last heading at or before it; one window for all of them. A document's lines are one group."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumns({h: F.last(h, ignorenulls=True).over(w) for h in headings})


def render(line: Column) -> Column:
    """List items as "- x", quotes as "> x"; other lines as they are."""
    return F.when(line.rlike(r"^\s*[-*+]\s+"), F.concat(F.lit("- "), F.regexp_replace(line, r"^\s*[-*+]\s+", ""))).when(line.rlike(r"^\s*>\s?"), F.concat(F.lit("> "), F.regexp_replace(line, r"^\s*>\s?", ""))).otherwise(line)


def ordinances(pages: DataFrame, key: str, markdown: str = "markdown") -> DataFrame:
    """key, chapter, section, heading, text of every section.

    Chapters are headings of depth 1 or 2, sections of depth 2 to 4; an article or part heading of depth 1 or 2 counts as a
    chapter. Text before the first section is dropped, and a new chapter ends the section before it. A single line over
    a row of = or - is a heading of depth 1 or 2; lines between fences are code: kept as they are, never headings.
    Fences and lines that are breaks alone are dropped.
    """
    lines = pages.select(key, F.posexplode(F.split(F.regexp_replace(markdown, "\r\n", "\n"), "\n")).alias("i", "line"))
    w = Window.partitionBy(key).orderBy("i")  # that of carry_headings: one sort
    fence = F.col("line").rlike(FENCE)
    lines = lines.withColumns({"fences": F.sum(fence.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)), "fence": fence})
    code = F.col("fence") | (F.col("fences") % 2 == 1)
    under = F.coalesce(F.lead("line").over(w), F.lit(""))
    plain = ~code & F.col("line").rlike(r"\S") & ~F.col("line").rlike(r"^\s*(?:#{1,6}\s|[-*+]\s|>|\d+[.)]\s)") & (F.trim(F.coalesce(F.lag("line").over(w), F.lit(""))) == "") & ~F.col("line").rlike(BREAK)
    rule = F.when(plain & under.rlike(r"^ {0,3}=+\s*$"), 1).when(plain & under.rlike(r"^ {0,3}-+\s*$"), 2).otherwise(0)
    lines = lines.withColumns({"code": code, "rule": rule})
    dropped = F.col("fence") | (F.coalesce(F.lag("rule").over(w), F.lit(0)) > 0) | (~F.col("code") & F.col("line").rlike(BREAK))
    lines = lines.withColumn("dropped", dropped)
    depth = F.when(F.col("code"), 0).when(F.col("rule") > 0, F.col("rule")).otherwise(F.length(F.regexp_extract("line", r"^(#{1,6})\s+\S", 1)))
    title = F.trim(F.regexp_replace("line", r"^#{1,6}\s+|\s+#*\s*$", ""))
    lines = lines.withColumns({"depth": depth, "title": title})
    is_chapter = (F.col("depth") > 0) & (F.col("depth") <= 2) & F.col("title").rlike(CHAPTER)
    is_section = ~is_chapter & F.col("depth").between(2, 4) & F.col("title").rlike(SECTION)
    is_part = ~is_chapter & ~is_section & (F.col("depth") > 0) & (F.col("depth") <= 2) & F.col("title").rlike(PART)
    lines = lines.withColumns({
        "chapter": F.when(is_chapter, F.regexp_extract("title", CHAPTER, 1)).when(is_part, F.regexp_extract("title", PART, 1)),
        "cut": F.when(is_chapter | is_part, F.struct(F.col("i"), F.lit(None).cast("string").alias("section"), F.lit(None).cast("string").alias("heading"))).when(
            is_section, F.struct(F.col("i"), F.regexp_extract("title", SECTION, 1).alias("section"), F.trim(F.regexp_extract("title", SECTION, 2)).alias("heading"))
        ),
    })
    body = carry_headings(lines, [key], "i", "chapter", "cut").where(F.col("cut.section").isNotNull() & (F.col("i") > F.col("cut.i")) & (F.col("depth") == 0) & ~F.col("dropped"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.when(F.col("code"), F.col("line")).otherwise(render(F.col("line"))).alias("t")))), lambda s: s["t"]), "\n")
    heads = carry_headings(lines, [key], "i", "chapter").where(F.col("cut.section").isNotNull())
    heads = heads.select(key, F.coalesce("chapter", F.lit("1")).alias("chapter"), F.col("cut.i").alias("at"), F.col("cut.section").alias("section"), F.col("cut.heading").alias("heading"))
    texts = body.groupBy(key, F.col("cut.i").alias("at")).agg(F.regexp_replace(F.trim(joined, F.lit(" \n\t")), r"\n{2,}", "\n\n").alias("text"))
    return heads.join(texts, [key, "at"], "left").select(key, "chapter", "section", "heading", F.coalesce("text", F.lit("")).alias("text"))


def subsections(text: Column) -> Column:
    """Inline markers, or without any those at line starts: array<struct<id, text>>."""
    def found(pattern: str) -> Column:
        ids, bodies = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (1, 2))
        return F.transform(F.arrays_zip(ids.alias("id"), bodies.alias("text")), lambda s: F.struct(F.concat(F.lit("("), s["id"], F.lit(")")).alias("id"), strip(s["text"]).alias("text")))

    first = found(INLINE)
    return F.when(F.size(first) > 0, first).otherwise(found(LINE))


def issues(rows: DataFrame) -> DataFrame:
    """Adds issues and is_valid: a section number of at most 20 characters, a heading, and at least 10 characters of text."""
    s, t = F.coalesce("section", F.lit("")), F.trim(F.coalesce("text", F.lit("")))
    found = F.array(F.when(s == "", "missing section"), F.when(F.length(t) < 10, "short text"), F.when(F.coalesce("heading", F.lit("")) == "", "missing heading"), F.when(F.length(s) > 20, "long section"))
    return rows.withColumn("issues", F.array_compact(found)).withColumn("is_valid", (s != "") & (F.length(t) >= 10))


def warnings(pages: DataFrame, checked: DataFrame, key: str) -> DataFrame:
    """key and warning of documents without sections, without a valid one, or with under half of them valid.

    checked: issues() of the documents' sections.
    """
    n, k = F.coalesce("n", F.lit(0)), F.coalesce("k", F.lit(0))
    counts = checked.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("k"))
    found = F.when(n == 0, "no sections").when(k == 0, F.format_string("all %d sections failed", n)).when(k < n * 0.5, F.format_string("only %d of %d sections are valid", k, n))
    return pages.select(key).distinct().join(counts, key, "left").select(key, found.alias("warning")).where("warning is not null")


def chapters(markdown: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(markdown, F.lit(r"(?im)^#{1,2}\s+.*?Chapter\s+([\d.]+)"), F.lit(1)))


def section_count(markdown: Column) -> Column:
    return F.regexp_count(markdown, F.lit(r"(?im)^#{2,4}\s+(?:Sec(?:tion)?\.?\s*)?[\d.-]+[.:\s-]+\s*\S"))
