"""Sections to token-bounded chunks.

A section within the limit is one chunk. A longer one is split at its subsection markers, or without any at paragraph
boundaries with overlap. All of it happens inside the row: no shuffle, whatever the number of sections. Families differ in the paragraph pattern and in how the overlap is counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspan.functions import text as T

#: Subsection markers at the start of a line, anywhere, and of rules.
LINE_MARKER = r"(?i)(?:^|\n)\s*(\([a-z0-9]+\)(?:\([a-z0-9]+\))*)\s+"
ANY_MARKER = r"(?i)\([a-z0-9]+\)(?:\([a-z0-9]+\))?(?:\([a-z0-9]+\))?"
RULE_MARKER = r"\([a-z]\)(?:\(\d+\))?(?:\([A-Z]\))?"
_CUT = "\x1e"


def subsections(text: Column, anchored: bool = True, marker: str | None = None, least: int = 0) -> Column:
    """array<struct<id, text>> of the bodies between markers; text before the first marker is dropped, as are bodies of
    `least` characters or fewer. A rule's capital letter is part of its id only behind a number."""
    pattern = marker or (LINE_MARKER if anchored else ANY_MARKER)
    group = 1 if anchored else 0
    ids = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    if marker == RULE_MARKER:
        ids = F.transform(ids, lambda x: F.regexp_replace(x, r"^(\([a-z]\))\([A-Z]\)$", "$1"))
    bodies = F.slice(F.split(F.regexp_replace(text, pattern, _CUT), _CUT), 2, 1 << 30)
    both = F.arrays_zip(ids.alias("id"), bodies.alias("text"))
    trimmed = F.transform(both, lambda s: F.struct(s["id"].alias("id"), T.strip(s["text"]).alias("text")))
    return F.filter(trimmed, lambda s: F.length(s["text"]) > least)


def paragraphs(text: Column, pattern: str = r"\n\n+|\n(?=\s{2,})", keep_blank: bool = False) -> Column:
    parts = F.split(text, pattern)
    return parts if keep_blank else F.filter(parts, lambda p: p.rlike(r"\S"))


def _tokens(chars: np.ndarray) -> np.ndarray:
    """text.tokens() of texts with so many UTF-16 units."""
    return np.ceil(np.ceil(chars / 4) * 1.1).astype(np.int64)


def runs(sizes: np.ndarray, limit: int, back: int) -> list[tuple[int, int, list[int]]]:
    """(first, last, []) of each run, from 1: each cut is a search in the sums of what comes before, so the work grows with the runs."""
    before, n = np.r_[0, np.cumsum(sizes)], len(sizes)
    out, start, least = [], 0, 1
    while n:
        end = max(least, int(np.searchsorted(before, before[start] + limit, "right")) - 1)
        out.append((start + 1, end, []))
        if end >= n:
            break
        start, least = max(start, int(np.searchsorted(before, before[end] - back, "left"))), end + 1
    return out


def joined_runs(chars: np.ndarray, limit: int, back: int) -> list[tuple[int, int, list[int]]]:
    """(first, last, head) of each run, from 1; head: the paragraphs that are joined into the run's overlap."""
    before, n = np.r_[0, np.cumsum(_tokens(chars))], len(chars)
    out, start, head, held = [], 0, [], 0
    while n:
        end = max(start + 1, int(np.searchsorted(before, before[start] + limit - held, "right")) - 1)
        out.append((start + 1, end, [i + 1 for i in head]))
        if end >= n:
            break
        at = max(start, int(np.searchsorted(before, before[end] - back, "left")))
        whole = at == start and head and before[end] - before[start] + held <= back
        head = [*(head if whole else []), *(i for i in range(at, end) if chars[i])]
        held = int(_tokens(np.array([sum(int(chars[i]) for i in head) + 2 * (len(head) - 1)]))[0]) if head else 0
        start = end
    return out


_RUN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("head", pa.list_(pa.int32()))])


def _packed(lists: Column, limit: int, overlap: float, joined: bool, chars: bool) -> Column:
    """array<array<struct<first, last, head>>> of lists of sizes. Sums that go on from one element to the next have no linear form among
    array functions, as a fold copies its state: an Arrow function over numbers alone, no text leaves the JVM."""
    back = int(limit * overlap)

    @F.arrow_udf("array<array<struct<first:int,last:int,head:array<int>>>>")
    def of(col: pa.Array) -> pa.Array:
        sizes = col.flatten()
        numbers = sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(np.r_[0, sizes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)]) if len(sizes) else np.zeros(1, np.int64)
        one = [(1, 1, [])]
        parts = []
        for lo, hi in zip(ends, ends[1:], strict=False):
            x = numbers[lo:hi]
            parts.append(one if hi - lo == 1 else joined_runs(x, limit, back) if joined else runs(_tokens(x) if chars else x, limit, back))
        inner = np.cumsum([0, *map(len, parts)])
        flat = [r for p in parts for r in p]
        heads = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[2]) for r in flat)]), pa.int32()), pa.array([i for r in flat for i in r[2]], pa.int32()))
        rows = pa.StructArray.from_arrays([pa.array([r[0] for r in flat], pa.int32()), pa.array([r[1] for r in flat], pa.int32()), heads], fields=list(_RUN))
        outer = np.cumsum([0, *(col.value_lengths().fill_null(0).to_pylist())])
        return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), pa.ListArray.from_arrays(pa.array(inner, pa.int32()), rows))

    return of(lists)


def _named(value: Column, use) -> Column:
    """use(value), where value is computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _part(p: Column, first: Column, last: Column) -> Column:
    """Elements first to last; unlike slice() it doesn't go through the whole array."""
    return F.transform(F.sequence(first, last), lambda j: F.element_at(p, j))


def pack(sizes: Column, limit: int = T.MAX_CHUNK, overlap: float = T.OVERLAP_SHARE) -> Column:
    """array<struct<first, last>>: runs of paragraphs (from 1) that a greedy packing makes.

    sizes: tokens of each paragraph. A run takes paragraphs while their sum stays within the limit; the next one begins
    with those whole last paragraphs of it that together have at most floor(limit * overlap) tokens.
    """
    found = _packed(F.array(sizes), limit, overlap, joined=False, chars=False)
    return F.transform(F.element_at(found, 1), lambda r: F.struct(r["first"].alias("first"), r["last"].alias("last")))


def split_parts(parts: Column, limit: int = T.MAX_CHUNK, overlap: float = T.OVERLAP_SHARE, joined: bool = False) -> Column:
    """array<array<struct<first, last, text>>> of lists of paragraphs: runs as pack() makes them, joined by blank lines.

    joined: a run's overlap is one paragraph of its own. It is the last whole paragraphs of the run before, without empty
    ones, that together have at most floor(limit * overlap) tokens, that run's own overlap counting as its first paragraph;
    joined by blank lines they are counted anew, as one text.
    """
    found = _packed(F.transform(parts, lambda p: F.transform(p, lambda x: F.coalesce(T.utf16_length(x).cast("int"), F.lit(0)))), limit, overlap, joined, chars=True)

    def text(p: Column, r: Column) -> Column:
        own = _part(p, r["first"], r["last"])
        if joined:
            head = F.array_join(F.transform(r["head"], lambda j: F.element_at(p, j)), "\n\n")
            own = F.when(F.size(r["head"]) > 0, F.concat(F.array(head), own)).otherwise(own)
        one = (r["first"] == r["last"]) & (F.size(r["head"]) == 0)  # a null text stays null
        return F.struct(r["first"].alias("first"), r["last"].alias("last"), F.when(one, F.element_at(p, r["first"])).otherwise(F.array_join(own, "\n\n")).alias("text"))

    both = F.struct(parts.alias("p"), found.alias("r"))
    return _named(both, lambda s: F.zip_with(s["p"], s["r"], lambda p, r: F.transform(r, lambda x: text(p, x))))


def split_with_overlap(text: Column, limit: int = T.MAX_CHUNK, overlap: float = T.OVERLAP_SHARE, pattern: str = r"\n\n+|\n(?=\s{2,})", keep_blank: bool = False, joined: bool = False) -> Column:
    """array<struct<first, last, text>> of a text's packed paragraphs (split_parts)."""
    return F.element_at(split_parts(F.array(paragraphs(text, pattern, keep_blank)), limit, overlap, joined), 1)


def tier(text: Column, limit: int = T.MAX_CHUNK) -> Column:
    return F.when(T.tokens(text) <= limit, "whole").when(F.size(subsections(text)) > 0, "subsections").otherwise("paragraphs")


def chunk(
    sections: DataFrame, text: str = "text", limit: int = T.MAX_CHUNK, pattern: str = r"\n\n+|\n(?=\s{2,})", keep_blank: bool = False, anchored: bool = True,
    joined: bool = False, marker: str | None = None, least: int = 0, given: str | None = None,
) -> DataFrame:
    """One row for each chunk: the section's columns (without its text), subsection, chunk_text, chunk_index, total_chunks.

    Subsections longer than the limit are split at paragraphs too. A single paragraph above the limit stays whole.
    given: a column of ready subsections (array<struct<id, text>>), taken instead of those that markers cut.
    """
    t = F.col(text)
    found = F.coalesce(F.col(given), F.array().cast("array<struct<id:string,text:string>>")) if given else subsections(t, anchored, marker, least)
    # Parts of the text, each a list of paragraphs; what fits within the limit is one paragraph.
    listed = lambda s: F.when(T.tokens(s) <= limit, F.array(s)).otherwise(paragraphs(s, pattern, keep_blank))
    alone = F.array(F.struct(F.lit(None).cast("string").alias("id"), t.alias("text")))
    rows = sections.withColumn("_of", F.when((T.tokens(t) > limit) & (F.size(found) > 0), F.transform(found, lambda s: F.struct(s["id"].cast("string").alias("id"), s["text"].alias("text")))).otherwise(alone))
    rows = rows.withColumn("_parts", F.transform("_of", lambda s: listed(s["text"])))
    runs_of = split_parts(F.col("_parts"), limit, joined=joined)
    rows = rows.withColumn("_chunks", F.flatten(F.zip_with("_of", runs_of, lambda s, r: F.transform(r, lambda c: F.struct(s["id"].alias("subsection"), c["text"].alias("chunk_text"))))))
    # Of a plain posexplode Spark infers a filter of empty lists, and moves it below with two more copies of all that makes them.
    return rows.select(
        *[c for c in sections.columns if c not in (text, given)], F.size("_chunks").alias("total_chunks"), F.posexplode_outer("_chunks").alias("chunk_index", "_c")
    ).where(F.col("chunk_index").isNotNull()).select("*", "_c.subsection", "_c.chunk_text").drop("_c")


def oversize(chunks: DataFrame, limit: int = T.MAX_CHUNK) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): chunks above the limit leave with a reason instead of failing the job."""
    n = T.tokens(F.col("chunk_text"))
    bad = chunks.where(n > limit).withColumn("reason", F.format_string("chunk of %d tokens is above the limit of %d", n, F.lit(limit)))
    return chunks.where(n <= limit), bad


def stats(chunks: DataFrame, *by: str, section: tuple[str, ...] = (), rounded: bool = False) -> DataFrame:
    """Counts, token sum, average, least and most, and how many sections were split.

    section: the columns that name a section, whose distinct ones are counted too. rounded: averages as whole numbers,
    halves up, as all families but the federal one report them.
    """
    n = T.tokens(F.col("chunk_text"))
    mean = F.floor(F.avg(n) + 0.5) if rounded else F.avg(n)
    distinct = [F.count_distinct(F.to_json(F.struct(*section), {"ignoreNullFields": "false"})).alias("sections")] if section else []
    return chunks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_chunks"), F.sum(n).alias("total_tokens"), mean.alias("avg_tokens"), F.min(n).alias("min_tokens"), F.max(n).alias("max_tokens"),
        F.count_if((F.col("total_chunks") > 1) & (F.col("chunk_index") == 0)).alias("split_sections"), *distinct,
    )


#: Families of sections: the chunk id's head, the registry column that names the source, the columns of its id.
FAMILIES = {
    "cfr": ("title", ("title", "part", "section")),
    "tx-statute": ("code", ("code", "chapter", "section")),
    "tx-tac": ("title", ("title", "chapter", "section")),
    "county": ("county", ("county", "chapter", "section")),
    "municipal": ("city_id", ("city_id", "chapter", "section")),
}


#: The marker and the longest body that is dropped, where sections come without subsections.
_MARKERS = {"tx-statute": (ANY_MARKER, 5), "tx-tac": (RULE_MARKER, 0)}


def family_chunks(sections: DataFrame, family: str, year: int, limit: int = T.MAX_CHUNK) -> DataFrame:
    """Chunks of one family's sections with chunk_id, source_id, citation and, but for counties, hierarchy.

    sections has the family's id columns as texts, text, and what its citation names: cfr chapter; tx-statute code_name
    and cited_as; tx-tac title_name; county code_name; municipal city. Federal paragraphs may begin at indented lines,
    and its citations end in the subsection; the other families keep blank paragraphs, count a chunk's overlap as one
    paragraph, and put a blank before the subsection. A column `subsections`, as the parsers of sources make it, holds
    if there is one; else markers are matched anywhere: statutes' bodies have over 5 characters, rules' markers are a
    lower-case letter, a number and a capital one. Municipal chunks count over the city, the others over their section.
    """
    source, ids = FAMILIES[family]
    federal = family == "cfr"
    options: dict = {} if federal else {"pattern": r"\n\n+", "keep_blank": True, "anchored": False, "joined": True}
    if not federal and "subsections" in sections.columns:
        options["given"] = "subsections"
    elif family in _MARKERS:
        options["marker"], options["least"] = _MARKERS[family]
    rows = chunk(sections, limit=limit, **options)
    c, sub = F.col, F.coalesce(F.concat(F.lit("" if federal else " "), "subsection"), F.lit(""))
    section = F.concat(c("section"), sub)
    if federal:
        cite, path = T.federal_citation(c("title"), c("section"), sub), T.federal_breadcrumb(c("title"), c("chapter"), c("part"), section)
    elif family == "tx-statute":
        cite, path = F.concat(T.statute_citation(c("cited_as"), c("section"), year), sub), T.state_breadcrumb("statute", c("code_name"), c("chapter"), section)
    elif family == "tx-tac":
        cite, path = F.concat(T.rule_citation(c("title"), c("section"), year), sub), T.state_breadcrumb("tac", c("title_name"), c("chapter"), section)
    elif family == "county":
        cite, path = F.concat(T.county_citation(c("county"), c("code_name"), c("section"), year), sub), None
    else:
        cite, path = F.concat(T.city_citation(c("city"), c("section"), year), sub), T.state_breadcrumb("municipal", c("city"), c("chapter"), section)
    added = {"chunk_id": T.chunk_id(family, *(c(i) for i in ids), c("chunk_index")), "source_id": T.source_id(family, c(source)), "citation": cite, "tokens": T.tokens(c("chunk_text"))}
    if path is not None:
        added["hierarchy"] = path
    out = rows.withColumns(added)
    if family == "municipal":
        city = Window.partitionBy("city_id")  # a city's chunks, not a corpus's
        out = out.withColumns({
            "total_chunks": F.count(F.lit(1)).over(city).cast("int"), "chunk_index": (F.row_number().over(city.orderBy("chapter", "section", "chunk_index")) - 1).cast("int"),
        })
    return out
