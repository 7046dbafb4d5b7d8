"""Ordinance sites by platform: contents links, sections and accessibility, from pages that were fetched already.

A platform is data: which selectors are tried in turn, what link titles are skipped, where numbers are taken from. Pages
go through Arrow functions, one row in and one out, so nothing shuffles; errors are columns, never exceptions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillspan.sources import dom

LINK = "array<struct<url:string,title:string,chapter:string,section:string>>"
SECTION = "array<struct<section:string,heading:string,text:string>>"
NUMBER = r"[\d.]+"


@dataclass(frozen=True)
class Platform:
    links: tuple[str, ...]
    skipped: tuple[str, ...]
    chapter: tuple[str, ...]
    section: tuple[str, ...]
    headings: tuple[str, ...]
    texts: tuple[str, ...]
    whole: str
    clutter: str
    #: Whether a skipped word anywhere in a title skips it, or only the whole title.
    skip_within: bool = False
    #: Selectors of several sections on a page, headings and paragraphs within them; without any, a page is one section.
    blocks: tuple[str, ...] = ()
    block_heading: str = ""
    block_text: str = ""
    block_least: int = 50
    whole_least: int = 50
    #: Part of the base link that relative links replace.
    drop: str = ""
    spacing: float = 1.0


# The sites' layouts.
PLATFORMS = {
    "municode": Platform(
        links=(".toc-link", ".toc-item a", "[data-toc-item] a", ".codes-toc a", "nav.toc a", 'a[href*="nodeId"]', 'a[href*="CHAPTER"]', 'a[href*="chapter"]'),
        skipped=("search", "help"), skip_within=True, chapter=(r"Chapter\s+(\d+)", r"^(\d+)\."), section=(r"(?:Section|Sec\.?)\s*([\d.-]+)", r"^([\d.-]+)"),
        headings=("h1, .page-title",), texts=(), whole="main, article, .content", clutter="", whole_least=101,
        blocks=(".chunk-content", ".section-content", "[data-section]", "article section", ".code-section", ".content-area p"),
        block_heading="h1, h2, h3, .section-heading, .section-title", block_text="p, .section-text, .section-body",
    ),
    "elaws": Platform(
        links=(".toc-item a", "#toc a", ".toc a", 'table a[href*="sec"]', 'table a[href*="SEC"]', 'table a[href*="ch"]', 'table a[href*="CH"]', 'a[href*="_sec"]', 'a[href*="_SEC"]', 'a[href*="article"]', 'a[href*="coor"]'),
        skipped=("home", "search", "help", "back"), chapter=(r"Chapter\s+(\d+)", r"Art(?:icle)?\.?\s*([IVXLCDM]+|\d+)"), section=(r"Sec(?:tion)?\.?\s*([\d.]+)", r"^([\d.]+)\s"),
        headings=("h1", "h2", ".section-title", "title"), texts=(".section-text", ".content", ".code-text", "main p", "article p", "table td", "body"),
        whole="body", clutter="script, style, nav, .toc, #toc, header, footer", drop=r"/[^/]*$",
    ),
    "amlegal": Platform(
        links=("[data-node-id]", "[data-nodeid]", ".toc-node a", ".toc-item a", ".tree-node a", 'nav a[href*="node"]', 'a[href*="nodeId"]', 'a[href*="NODEID"]'),
        skipped=("search", "help", "home", "print"), chapter=(r"Chapter\s+(\d+)", r"CHAPTER_?(\d+)", r"^(\d+)\."), section=(r"Sec(?:tion)?\.?\s*([\d.]+)", r"SEC(?:TION)?_?([\d.]+)", r"^[\d.]+[.-]([\d.]+)"),
        headings=(".section-heading", "h1", "h2", ".node-title"), texts=(".section-content", ".code-text", ".node-content", "main .content", "article", ".code-body"),
        whole="main, article, .content, body", clutter="script, style, nav, .toc, .sidebar, header, footer", drop=r"/overview$", spacing=5.0,
    ),
}


def _first(patterns: Sequence[str], *texts: str) -> str:
    for p in patterns:
        for t in texts:
            if m := re.search(p, t, re.I):
                return m[1]
    return "0"


def absolute(href: str, base: str, drop: str = "") -> str:
    """href as seen from base: absolute links as they are, rooted ones on its host, others below it."""
    if href.startswith("http"):
        return href
    at = urlsplit(base)
    if href.startswith("/"):
        return f"{at.scheme}://{at.netloc}{href}"
    return f"{re.sub(drop, '', base) if drop else base}/{href}"


def links_of(html: str | None, base: str, p: Platform) -> list[dict]:
    """Distinct links of the first selector that yields any, by chapter, then section number; equal ones in page order."""
    page, out = dom.parse(html), {}
    for selector in p.links:
        for e in page.select(selector):
            href, title = e.attrs.get("href", ""), e.text()
            low = title.lower()
            if not href or not title or (any(s in low for s in p.skipped) if p.skip_within else low in p.skipped):
                continue
            node = e.attrs.get("data-node-id") or e.attrs.get("data-nodeid") or ""
            url = absolute(href, base, p.drop)
            out.setdefault(url, {"url": url, "title": title, "chapter": _first(p.chapter, title, node), "section": _first(p.section, title, node)})
        if out:
            break

    def number(x: str) -> float:
        m = re.match(r"\d+(?:\.\d+)?", x)
        return float(m[0]) if m else 0.0

    return sorted(out.values(), key=lambda r: (number(r["chapter"]), number(r["section"])))


def sections_of(html: str | None, p: Platform, title: str = "", number: str = "0") -> list[dict]:
    """Sections of a page; none if it holds too little text."""
    page, out = dom.parse(html), []
    for selector in p.blocks:
        for block in page.select(selector):
            head = next((t for e in (*block.select(p.block_heading)[:1], *block.select("strong, b")[:1]) if (t := e.text())), "")
            text = "\n\n".join(e.text() for e in block.select(p.block_text))
            if head and len(text) > p.block_least:
                out.append({"section": _first(p.section, head), "heading": head, "text": text})
        if out:
            return out
    head = next((t for s in p.headings for e in page.select(s)[:1] if (t := e.text())), "") or title or f"Section {number}"
    for selector in p.texts:
        text = "".join(e.text(p.clutter) for e in page.select(selector)).strip()
        if len(text) > 100:
            return [{"section": number, "heading": head, "text": text}]
    found = page.select(p.whole)
    text = found[0].text(p.clutter) if found else ""
    if not p.blocks:
        text = " ".join(text.split())
    return [{"section": number, "heading": head, "text": text}] if len(text) >= p.whole_least else []


_LINK = pa.list_(pa.struct([(n, pa.string()) for n in ("url", "title", "chapter", "section")]))
_SECTION = pa.list_(pa.struct([(n, pa.string()) for n in ("section", "heading", "text")]))


def contents(html: Column, base: Column, platform: Column) -> Column:
    """Links of a contents page; none for a platform without a layout here."""

    @F.arrow_udf(LINK)
    def of(html: pa.Array, base: pa.Array, platform: pa.Array) -> pa.Array:
        rows = zip(html.to_pylist(), base.to_pylist(), platform.to_pylist(), strict=True)
        return pa.array([links_of(h, b or "", PLATFORMS[p]) if p in PLATFORMS else [] for h, b, p in rows], _LINK)

    return of(html, base, platform)


def ordinances(pages: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """(sections, rejected) of fetched section pages with columns platform, title and section; the others are kept.

    Pages without enough text, and those of a platform without a layout, are rejected with a reason.
    """

    @F.arrow_udf(SECTION)
    def of(html: pa.Array, platform: pa.Array, title: pa.Array, number: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (html, platform, title, number)), strict=True)
        return pa.array([sections_of(h, PLATFORMS[p], t or "", n or "0") if p in PLATFORMS else [] for h, p, t, n in rows], _SECTION)

    rest = [c for c in pages.columns if c not in (html, "title", "section")]
    done = pages.withColumn("_s", of(F.col(html), F.col("platform"), F.col("title"), F.col("section")))
    reason = F.when(F.col("platform").isin(*PLATFORMS), "insufficient content").otherwise("no layout for platform")
    return done.select(*rest, F.inline("_s")), done.where(F.size("_s") == 0).select(*rest, reason.alias("reason"))


def readable(registry: DataFrame) -> DataFrame:
    """Registry rows that have an adapter: enabled, with a base link, on a known platform."""
    return registry.where(F.col("enabled") & (F.coalesce("base_url", F.lit("")) != "") & F.col("platform").isin(*PLATFORMS))


def adapter(registry: DataFrame, name: str) -> Platform | None:
    """The platform that reads a source by its name (case ignored); None for unknown, disabled and unsupported ones."""
    row = readable(registry).where(F.lower("name") == name.lower()).select("platform").first()
    return PLATFORMS[row[0]] if row else None


def checked(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds accessible and error: a page came, and it shows links or sections as its platform lays them out."""
    found = F.size(contents(F.col(html), F.col("base_url"), F.col("platform"))) > 0
    error = F.when(F.coalesce(html, F.lit("")) == "", "source not accessible").when(~F.col("platform").isin(*PLATFORMS), "no layout for platform").when(~found, "expected elements not found")
    return pages.withColumn("error", error).withColumn("accessible", F.col("error").isNull())
