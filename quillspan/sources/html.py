"""Statute and rule pages: discovery of links, and headings and texts by selector cascades."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillspan.functions.text import clean_html_text
from quillspan.operators.chunk import ANY_MARKER, RULE_MARKER, subsections
from quillspan.sources import dom

# What is tried in turn, as tag, .class, or tag.class.
STATUTE_HEADINGS = ("h2.section-heading", "h2", ".statute-heading", "p.heading", "b")
STATUTE_TEXTS = (".section-text", ".statute-body", "article", "main", "body")
RULE_HEADINGS = (".rule-heading", ".tac-heading", ".rule-title", "[class*=heading]", "h1", "h2", "h3", "h4", "strong", "b")
RULE_TEXTS = (".rule-text", ".tac-body", ".rule-content", ".tac-content", "article", "main", ".content", "#content", "[role*=main]")
RULE_PARAGRAPHS = "p, div.paragraph, section"
RULE_CLUTTER = "nav, header, footer, .navigation, .breadcrumb"
#: Tasks a core that pages are dealt to before they are parsed.
SPREAD = 4
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Tree(HTMLParser):
    """Elements with their text, in document order. Unclosed elements end with their parent."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[dict] = []
        self.open: list[dict] = []

    def handle_starttag(self, tag, attrs):
        e = {"tag": tag, "class": (dict(attrs).get("class") or "").split(), "text": []}
        self.found.append(e)
        if tag not in _VOID:
            self.open.append(e)

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i]["tag"] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if not any(e["tag"] in ("script", "style") for e in self.open):
            for e in self.open:
                e["text"].append(data)


def first_texts(html: str | None, *selectors: tuple[str, ...]) -> list[str]:
    """For each list of selectors the text of the first element that its first matching selector with any text finds; one parse."""
    tree = _Tree()
    dom.feed(tree, html or "")
    return [_first(tree.found, s) for s in selectors]


def _first(found: list[dict], selectors: tuple[str, ...]) -> str:
    for s in selectors:
        tag, _, cls = s.partition(".")
        for e in found:
            if (not tag or e["tag"] == tag) and (not cls or cls in e["class"]):
                text = "".join(e["text"]).strip()
                if text:
                    return text
                break
    return ""


def first_text(html: str | None, selectors: tuple[str, ...]) -> str:
    return first_texts(html, selectors)[0]


def select_text(html: Column, selectors: tuple[str, ...]) -> Column:
    """HTML parsing has no built-in form: an Arrow function."""

    @F.arrow_udf("string")
    def of(col: pa.Array) -> pa.Array:
        return pa.array([first_text(h, selectors) for h in col.to_pylist()], pa.string())

    return of(html)


def _once(pages: DataFrame, html: str, read: Callable[[str | None], tuple[str, str]]) -> DataFrame:
    """Adds heading and text of each page, read in Python. Pages are dealt to all cores first, as a small file of many pages is
    one task's; the function counts as not deterministic, so that filters on its result don't make Spark call it again."""

    @F.arrow_udf("struct<heading:string,text:string>")
    def of(col: pa.Array) -> pa.Array:
        both = [read(h) for h in col.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([b[i] for b in both], pa.string()) for i in (0, 1)], names=["heading", "text"])

    found = pages.repartition(SPREAD * pages.sparkSession.sparkContext.defaultParallelism).withColumn("_read", of.asNondeterministic()(F.col(html)))
    return found.withColumns({"heading": F.col("_read.heading"), "text": F.col("_read.text")}).drop("_read")


def parse_statutes(pages: DataFrame, html: str = "html", least: int = 10) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejected): adds heading, text and subsections; texts under `least` characters are rejected with a reason."""
    out = _once(pages, html, lambda h: first_texts(h, STATUTE_HEADINGS, STATUTE_TEXTS)).withColumn("text", clean_html_text(F.col("text")))
    out = out.withColumn("subsections", subsections(F.col("text"), anchored=False, marker=ANY_MARKER, least=5))
    return out.where(F.length("text") >= least), out.where(F.length("text") < least).withColumn("reason", F.lit("text too short"))


def rule_of(html: str | None) -> dict[str, str]:
    """Heading, without its number, and text of a rule's page: the paragraphs of the first block that has any or over 50
    characters, without menus; else the whole body."""
    page = dom.parse(html)
    first = lambda s: page.select(s)[:1]
    heading = next((t for s in RULE_HEADINGS for e in first(s) if (t := e.text())), "")
    heading = re.sub(r"^§?\s*[\d.]+\s*[-–—]\s*", "", heading).strip()
    for e in (e for s in RULE_TEXTS for e in first(s)):
        hidden = {id(x) for c in e.select(RULE_CLUTTER) for x in c.walk()}
        parts = [t for x in e.select(RULE_PARAGRAPHS) if id(x) not in hidden and (t := x.text(RULE_CLUTTER))]
        if parts:
            return {"heading": heading, "text": "\n\n".join(parts)}
        if len(text := e.text(RULE_CLUTTER)) > 50:
            return {"heading": heading, "text": " ".join(text.split())}
    text = (*first("body"), page)[0].text(f"{RULE_CLUTTER}, .menu, head, title")
    return {"heading": heading, "text": " ".join(text.split())}


def parse_rules(pages: DataFrame, html: str = "html", least: int = 20) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejected): as parse_statutes, for rules."""
    out = _once(pages, html, lambda h: tuple(rule_of(h).values()))
    out = out.withColumn("subsections", subsections(F.col("text"), anchored=False, marker=RULE_MARKER))
    return out.where(F.length("text") >= least), out.where(F.length("text") < least).withColumn("reason", F.lit("text too short"))


def discovered(html: Column, pattern: str | Column, number: str = "int") -> Column:
    """Distinct first groups of a pattern, sorted as whole numbers (int), major.minor pairs (pair) or decimals (float)."""
    found = F.array_distinct(F.regexp_extract_all(html, pattern if isinstance(pattern, Column) else F.lit(pattern), F.lit(1)))
    key = {"int": lambda x: F.array(x.cast("int")), "pair": lambda x: F.transform(F.split(x, r"\."), lambda p: p.cast("int")), "float": lambda x: F.array(x.cast("double"))}[number]
    return F.transform(F.array_sort(F.transform(found, lambda x: F.struct(key(x).alias("k"), x.alias("x")))), lambda s: s["x"])


def _quoted(before: str, value: str | Column, after: str) -> Column:
    return F.concat(F.lit(before + r"\Q"), value if isinstance(value, Column) else F.lit(value), F.lit(r"\E" + after))


def code_chapters(html: Column, code: str | Column) -> Column:
    return discovered(html, _quoted("(?i)", code, r"\.(\d+)\.htm"))


def chapter_sections(html: Column, code: str | Column, chapter: str | Column) -> Column:
    head = F.concat(_quoted("(?i)", code, r"\.("), _quoted("", chapter, r"\.\d+)\.htm"))
    return discovered(html, head, "pair")


def rule_chapters(html: Column) -> Column:
    both = F.array_union(discovered(html, r"[?&]ch=(\d+)"), discovered(html, r"Chapter\s+(\d+)"))
    return F.array_sort(both, lambda a, b: a.cast("int") - b.cast("int"))


def chapter_rules(html: Column, chapter: str | Column) -> Column:
    """Rule numbers of a chapter from links and from section signs in the text, in number order."""
    named = [_quoted(head, chapter, r"\.[\d.]+)") for head in (r"§\s*(", r"(?i)Section\s+(")]
    found = [discovered(html, p, "float") for p in (r"[?&]rl=([\d.]+)", *named)]
    both = F.array_union(F.array_union(found[0], found[1]), found[2])
    number = lambda x: x.try_cast("double")
    return F.array_sort(both, lambda a, b: F.when(number(a) < number(b), -1).when(number(a) > number(b), 1).otherwise(0))
