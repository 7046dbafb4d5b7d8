"""Prompts with numbered sources, and answers back to citations, permits and sections."""

from __future__ import annotations

from collections.abc import Sequence

import re

import pyarrow as pa

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspan.functions import text as T

LEVELS = ("federal", "state", "county", "municipal")


def numbered(chunks: DataFrame, order: Sequence[Column], question: str | None = None) -> DataFrame:
    """Adds position, from 1, in the given order within each question."""
    return chunks.withColumn("position", F.row_number().over(Window.partitionBy(*([question] if question else [])).orderBy(*order)))


def source_header(title: bool = True) -> Column:
    head = F.concat(F.lit("["), F.col("position").cast("string"), F.lit("] "), F.col("citation"), F.lit(" ("), F.col("jurisdiction"), F.lit(", "), F.col("source_type"), F.lit(")"))
    if not title:
        return head
    return F.concat(head, F.when(F.coalesce("title", F.lit("")) != "", F.concat(F.lit("\nTitle: "), "title")).otherwise(""))


def _joined(rows: DataFrame, by: Sequence[str], value: Column, sep: str, name: str) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct("position", value.alias("v"))))
    return rows.groupBy(*by).agg(F.array_join(F.transform(items, lambda s: s["v"]), sep).alias(name))


def source_block(rows: DataFrame, *by: str) -> DataFrame:
    return _joined(rows, by, F.concat(source_header(), F.lit("\n\n"), F.col("text")), "\n\n---\n\n", "sources")


def citation_list(rows: DataFrame, *by: str) -> DataFrame:
    return _joined(rows, by, source_header(title=False), "\n", "citations")


def user_prompt(question: Column, jurisdictions: Column, sources: Column) -> Column:
    """Question, jurisdictions if any, and the numbered sources. The wording is this engine's own; only the numbering must hold."""
    where = F.when(F.size(jurisdictions) > 0, F.concat(F.lit("\nRelevant jurisdictions: "), F.array_join(jurisdictions, ", "))).otherwise("")
    return F.concat(F.lit("Question: "), question, where, F.lit("\n\n## Sources (cite as [N])\n\n"), sources, F.lit("\n\n## Task\nAnswer from the sources above only, by jurisdiction level, and list required permits and licenses."))


def references(text: Column) -> Column:
    """Distinct [N] references in the order they are first seen."""
    return F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\[(\d+)\]"), F.lit(1))), lambda x: x.cast("int"))


def valid_references(text: Column, n: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(references(text), lambda x: (x >= 1) & (x <= n))))


def invalid_references(text: Column, n: Column) -> Column:
    return F.array_distinct(F.filter(references(text), lambda x: (x < 1) | (x > n)))


def warnings(text: Column, n: Column) -> Column:
    bad = invalid_references(text, n)
    return F.when(F.size(bad) > 0, F.array(F.concat(F.lit("Invalid citation references found: ["), F.array_join(bad.cast("array<string>"), ", "), F.lit("] (references to non-existent chunks)")))).otherwise(F.array().cast("array<string>"))


def cited(answers: DataFrame, chunks: DataFrame, key: str, *more: str) -> DataFrame:
    """Each answer's valid references with the chunk at that position: id, citation, excerpt. more: columns that tell the answers to one
    key's chunks apart."""
    refs = answers.select(key, *more, F.explode(F.array_distinct(references(F.col("answer")))).alias("position"))
    return refs.join(chunks, [key, "position"]).withColumn("excerpt", T.excerpt(F.col("text")))


def section(text: Column, level: str) -> Column:
    return T.strip(F.regexp_extract(text, rf"(?is)###\s*{level}[^\n]*\n(.*?)(?=###|\z)", 1))


def section_name(text: Column, level: str) -> Column:
    head = F.regexp_extract(text, rf"(?i)###\s*{level}[^\n]*", 0)
    name = T.strip(F.regexp_replace(F.regexp_replace(F.regexp_replace(head, "###", ""), f"(?i){level}", ""), "(?i)requirements?", ""))
    return F.when(name != "", name).otherwise(level.capitalize())


def sections(answers: DataFrame, key: str) -> DataFrame:
    """One row for each level that an answer has a section of."""
    t = F.col("answer")
    has = lambda v: t.rlike(rf"(?i)###\s*{v}[^\n]*\n")
    each = F.array(*[F.when(has(v), F.struct(F.lit(v).alias("level"), section_name(t, v).alias("name"), section(t, v).alias("content"))) for v in LEVELS])
    return answers.select(key, F.inline(F.filter(each, lambda s: s.isNotNull())))


_PERMITS = re.compile(r"###?\s*Required Permits.*?(?=###|\Z)", re.I | re.S)
_FIELD = re.compile(r"\*\*(Permit Name|Issuing Agency|Jurisdiction|Link|Regulatory Reference)\*\*:[ \t]*([^\n]*)", re.I)


def permits_of(text: str | None) -> list[dict]:
    """Permits of the first permits block. A permit starts at its name and needs all fields but the link."""
    block = _PERMITS.search(text or "")
    out, now = [], {}
    for name, value in _FIELD.findall(block[0]) if block else ():
        name, value = name.lower(), value.strip()
        if name == "permit name":
            now = {}
        now.setdefault(name, value)
        if name == "regulatory reference" and all(now.get(k) for k in ("permit name", "issuing agency", "jurisdiction", "regulatory reference")):
            out.append({"name": now["permit name"], "agency": now["issuing agency"], "jurisdiction": now["jurisdiction"], "url": now.get("link"), "citation": now["regulatory reference"]})
            now = {}
    return out


def permits(text: Column) -> Column:
    """Repeated matches of five fields have no built-in form: an Arrow function."""
    kind = pa.list_(pa.struct([(n, pa.string()) for n in ("name", "agency", "jurisdiction", "url", "citation")]))

    @F.arrow_udf("array<struct<name:string,agency:string,jurisdiction:string,url:string,citation:string>>")
    def of(col: pa.Array) -> pa.Array:
        return pa.array([permits_of(t) for t in col.to_pylist()], kind)

    return of(text)
