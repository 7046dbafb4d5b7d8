"""Crawls: contents pages to the pages they name, a level at a time, and those to the rows of a family's sections.

Every source of a family is crawled by one plan: a level's links are rows, so are its pages. A level is a table in the
control folder: a crawl that stopped goes on after its last whole level, and nothing is fetched twice. What can't be
fetched or parsed leaves as rows (source_id, url, stage, reason) and stops no other page. Missing section pages are
skipped without one: contents often name pages that are gone.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillspan.functions import text as T
from quillspan.operators.control import Control
from quillspan.sources import blocks as K, fetch as N, html as H, markdown as M, objects as O, platforms as L, xml as X

# Where contents and documents are.
FEDERAL = "https://www.ecfr.gov/api/versioner/v1/full/"
STATUTES = "https://statutes.capitol.texas.gov/Docs/"
#: Seconds between calls to one host that keeps cities' pages.
CITY_SPACING = 2.0
#: The part under which a title is stored that came as one document.
WHOLE = "all"
RULES = "https://texreg.sos.state.tx.us/public/readtac$ext.ViewTAC?tac_view="


class Crawl:
    """A run's pages, kept under its name. store: a folder where documents are kept as objects too (sources.objects), by the keys
    of their family. days: how old a held level may be. options go to fetch()."""

    def __init__(self, control: Control, run: str, get: Callable[[str], str], store: str | None = None, days: float | None = None, now: float | None = None, **options):
        self.control, self.run, self.get, self.store, self.days, self.options = control, run, get, store, days, options
        self.now = time.time() if now is None else now
        self.anew = False

    def keep(self, pages: DataFrame, family: str) -> None:
        """Store the pages that came, if there is a store."""
        if self.store and self.anew:
            O.put(pages.where("status = 'ok' and http = 200"), self.store, O.KEYS[family])

    def _held(self, level: str) -> DataFrame | None:
        """A level's table, unless it is older than `days`."""
        if self.anew:
            return None
        if self.days is not None:
            made = (self.control.get(f"{self.run}/{level}-time") or {}).get("time")
            if made is None or self.now - made > self.days * 86_400:
                return None
        return self.control.load_step(self.run, level)

    def pages(self, level: str, urls: DataFrame, spacing: str | float | None = None, cache: DataFrame | None = None) -> DataFrame:
        """urls with status, body, error and http (typed()). A held level counts if it isn't too old, has all of urls and none of them
        failed; if one is fetched, so are all levels after it. cache (url, body, stored_at): what is fresh in it isn't fetched."""
        held = self._held(level)
        if held is not None:
            have = urls.select("url").distinct().join(held.select("url", "status"), "url", "left")
            held = held if have.where("status is null or status = 'failed'").isEmpty() else None
        if held is None:
            self.anew = True
            options = {**self.options, **({"spacing": spacing} if spacing and "spacing" not in self.options else {})}
            if cache is None:
                got = N.fetch(urls, self.get, **options)
            else:
                fetched = lambda d: self.control.save_step(self.run, f"{level}-fetched", d)
                got = N.read_through(urls, cache, self.get, fetched, F.timestamp_seconds(F.lit(self.now)), 7 if self.days is None else self.days, **options)
            held = self.control.save_step(self.run, level, got)
            self.control.put(f"{self.run}/{level}-time", {"time": self.now})
        return N.typed(urls.join(held, "url"))


def _rejects(pages: DataFrame, stage: str, source: Column, skip_missing: bool = False) -> DataFrame:
    bad = pages.where((F.col("http") != 200) & ~(F.lit(skip_missing) & (F.col("http") == 404)))
    reason = F.format_string("%d: %s", F.col("http"), F.coalesce("error", F.lit("empty page")))
    return bad.select(source.alias("source_id"), "url", F.lit(stage).alias("stage"), reason.alias("reason"))


def _unparsed(rows: DataFrame, source: Column) -> DataFrame:
    return rows.select(source.alias("source_id"), "url", F.lit("parse").alias("stage"), "reason")


def regulations(titles: DataFrame, crawl: Crawl, date: str, parts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Sections of whole titles (number, name), or with parts (number, part) of these alone, which the source then picks.

    The chapter is I throughout.
    """
    title = F.col("number").cast("string")
    url = F.concat(F.lit(f"{FEDERAL}{date}/title-"), title, F.lit(".xml"))
    wanted = titles.select("number", F.col("name").alias("known_as"))
    if parts is not None:
        wanted = wanted.join(parts.select("number", F.col("part").cast("string").alias("only")), "number")
        url = F.concat(url, F.lit("?part="), F.col("only"))
    pages = crawl.pages("documents", wanted.withColumn("url", url))
    crawl.keep(pages.select("status", "http", title.alias("title"), (F.col("only") if parts is not None else F.lit(WHOLE)).alias("part"), "body"), "cfr")
    return _regulations(pages)


def _regulations(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    title = F.col("number").cast("string")
    source = T.source_id("cfr", title)
    found, bad = X.parse(pages.where("http = 200").select("number", "known_as", "url", F.col("body").alias("xml")))
    sections = found.select(
        title.alias("title"), F.col("known_as").alias("title_name"), F.lit("I").alias("chapter"), F.col("part").cast("string").alias("part"), "part_name", "section", "heading", "text", T.federal_url(title, F.col("part").cast("string"), F.col("section")).alias("url")
    )
    return sections, _rejects(pages, "fetch", source).unionByName(_unparsed(bad, source))


def statutes(codes: DataFrame, crawl: Crawl) -> tuple[DataFrame, DataFrame]:
    """Sections of codes (code, name, cited_as): contents, then chapters, then sections."""
    code, chapter, source = F.col("code"), F.col("chapter"), T.source_id("tx-statute", F.col("code"))
    at = lambda *rest: F.concat(F.lit(STATUTES), code, F.lit("/htm/"), code, F.lit("."), *rest, F.lit(".htm"))
    top = crawl.pages("contents", codes.select("code", F.col("name").alias("code_name"), "cited_as", at(F.lit("toc")).alias("url")))
    keep = ["code", "code_name", "cited_as"]
    chapters = top.where("body is not null").select(*keep, F.explode(H.code_chapters(F.col("body"), code)).alias("chapter"))
    middle = crawl.pages("chapters", chapters.withColumn("url", at(chapter)))
    named = middle.where("body is not null").select(*keep, "chapter", F.explode(H.chapter_sections(F.col("body"), code, chapter)).alias("section"))
    pages = crawl.pages("sections", named.withColumn("url", T.statute_url(code, F.col("section"))))
    crawl.keep(pages, "tx-statute")
    return _parsed(H.parse_statutes, pages, [*keep, "chapter", "section"], source, [top, middle])


def rules(titles: DataFrame, crawl: Crawl) -> tuple[DataFrame, DataFrame]:
    """Rules of titles (number, name): contents, then chapters, then rules. A chapter that fails costs its own rules only."""
    title, chapter, source = F.col("title"), F.col("chapter"), T.source_id("tx-tac", F.col("title"))
    known = titles.select(F.col("number").cast("string").alias("title"), F.col("name").alias("title_name"))
    top = crawl.pages("contents", known.withColumn("url", F.concat(F.lit(f"{RULES}3&ti="), title)))
    chapters = top.where("body is not null").select("title", "title_name", F.explode(H.rule_chapters(F.col("body"))).alias("chapter"))
    middle = crawl.pages("chapters", chapters.withColumn("url", F.concat(F.lit(f"{RULES}4&ti="), title, F.lit("&ch="), chapter)))
    named = middle.where("body is not null").select("title", "title_name", "chapter", F.explode(H.chapter_rules(F.col("body"), chapter)).alias("section"))
    pages = crawl.pages("sections", named.withColumn("url", T.rule_url(title, chapter, F.col("section"))))
    crawl.keep(pages, "tx-tac")
    return _parsed(H.parse_rules, pages, ["title", "title_name", "chapter", "section"], source, [top, middle])


def _parsed(parse: Callable, pages: DataFrame, keep: list[str], source: Column, above: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    good, short = parse(pages.where("http = 200").select(*keep, "url", F.col("body").alias("html")))
    bad = _rejects(pages, "fetch", source, skip_missing=True).unionByName(_unparsed(short, source))
    for level, stage in zip(above, ("contents", "chapter"), strict=False):
        bad = bad.unionByName(_rejects(level, stage, source))
    return good.drop("html"), bad


def counties(registry: DataFrame, crawl: Crawl) -> tuple[DataFrame, DataFrame]:
    """Ordinances of counties (name, platform, base_url, enabled), each platform's pages at its own spacing."""
    source = T.source_id("county", F.col("county"))
    wait = F.create_map(*(F.lit(x) for p, at in L.PLATFORMS.items() for x in (p, at.spacing)))[F.col("platform")]
    known = L.readable(registry).select(F.col("name").alias("county"), "platform", "base_url", F.col("base_url").alias("url"), wait.alias("wait"))
    top = crawl.pages("contents", known, "wait")
    seen = L.checked(top.where("http = 200"), "body")
    link = F.explode(L.contents(F.col("body"), F.col("base_url"), F.col("platform"))).alias("l")
    links = top.where("http = 200").select("county", "platform", "wait", link).select("county", "platform", "wait", "l.*")
    pages = crawl.pages("sections", links, "wait")
    crawl.keep(pages.join(registry.select(F.col("name").alias("county"), "fips"), "county"), "county")
    good, short = L.ordinances(pages.where("http = 200").select("county", "platform", "url", "chapter", "title", "section", "body"), "body")
    bad = _rejects(top, "contents", source).unionByName(_rejects(pages, "fetch", source, skip_missing=True)).unionByName(_unparsed(short, source))
    bad = bad.unionByName(_unparsed(seen.where("not accessible").withColumnRenamed("error", "reason"), source))
    return good.select("county", F.lit("Code of Ordinances").alias("code_name"), "chapter", "section", "heading", "text", "url"), bad


def cities(registry: DataFrame, crawl: Crawl) -> tuple[DataFrame, DataFrame]:
    """Ordinances of cities (name, city_id, platform, base_url), whose pages come as Markdown; a page that the crawl's store holds and
    that is fresh is not fetched.

    Rows without a section number or 10 characters of text are rejected, as is a city that has no valid row.
    """
    named = registry.where("enabled").select("city_id", F.col("name").alias("city"), "platform", "base_url", F.col("base_url").alias("url"))
    cache = None
    if crawl.store:
        cache = O.stored(registry.sparkSession, crawl.store, O.KEYS["municipal"]).join(named.select("city_id", "url"), "city_id").select("url", "body", "stored_at")
    pages = crawl.pages("documents", named, CITY_SPACING, cache)
    crawl.keep(pages, "municipal")
    return _cities(pages)


def _cities(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    source = T.source_id("municipal", F.col("city_id"))
    ready = pages.where("http = 200").withColumn("markdown", T.clean_markdown(F.col("body")))
    known = ready.select("city_id", "city", "platform", "base_url")
    rows = M.issues(K.ordinances(ready, "city_id")).join(known, "city_id")
    url = T.ordinance_url("municipal", F.col("platform"), F.col("base_url"), F.col("section"))
    good = rows.where("is_valid").select("city_id", "city", "chapter", "section", "heading", "text", M.subsections(F.col("text")).alias("subsections"), url.alias("url"))
    short = rows.where("not is_valid").select(source.alias("source_id"), url.alias("url"), F.lit("parse").alias("stage"), F.array_join("issues", ", ").alias("reason"))
    none = ready.join(good.select("city_id").distinct(), "city_id", "left_anti").select(source.alias("source_id"), "url", F.lit("parse").alias("stage"), F.lit("no valid sections").alias("reason"))
    return good, _rejects(pages, "fetch", source).unionByName(short).unionByName(none)


def from_store(spark: SparkSession, root: str, family: str, registry: DataFrame, **where: object) -> tuple[DataFrame, DataFrame]:
    """(sections, rejected) of documents that a crawl stored, without fetching: those of the registry's sources whose key columns
    have the given values (one, or a list), as title="21", part=["101", "117"]. Only their objects are listed and read."""
    rows = O.stored(spark, root, O.KEYS[family])
    for name, value in where.items():
        rows = rows.where(F.col(name).isin(*value) if isinstance(value, (list, tuple, set)) else F.col(name) == F.lit(str(value)))
    pages = rows.withColumns({"url": F.col("key"), "http": F.lit(200), "error": F.lit(None).cast("string")})
    if family == "cfr":
        known = registry.select("number", F.col("name").alias("known_as"))
        return _regulations(pages.join(known, F.col("title") == F.col("number").cast("string")).drop("title"))
    if family == "tx-statute":
        keep = ["code", "code_name", "cited_as"]
        pages = pages.join(registry.select("code", F.col("name").alias("code_name"), "cited_as"), "code")
        return _parsed(H.parse_statutes, pages, [*keep, "chapter", "section"], T.source_id("tx-statute", F.col("code")), [])
    if family == "tx-tac":
        pages = pages.join(registry.select(F.col("number").cast("string").alias("title"), F.col("name").alias("title_name")), "title")
        return _parsed(H.parse_rules, pages, ["title", "title_name", "chapter", "section"], T.source_id("tx-tac", F.col("title")), [])
    if family == "county":
        pages = pages.join(registry.select("fips", F.col("name").alias("county"), "platform"), "fips").withColumn("title", F.lit(None).cast("string"))
        good, short = L.ordinances(pages.select("county", "platform", "url", "chapter", "title", "section", "body"), "body")
        bad = _unparsed(short, T.source_id("county", F.col("county")))
        return good.select("county", F.lit("Code of Ordinances").alias("code_name"), "chapter", "section", "heading", "text", "url"), bad
    return _cities(pages.join(registry.select("city_id", F.col("name").alias("city"), "platform", "base_url"), "city_id"))
