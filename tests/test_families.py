"""Whole runs of each family over fixture pages: crawl, sections, chunks, vectors, index and statuses."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillspan.functions import retry
from quillspan.operators import chunk as C, quality as Q
from quillspan.operators.control import Control
from quillspan.plans import families as A, pipelines, providers as P
from quillspan.sources import crawl as W, fetch as N, html as H, markdown as M

NOW = dt.datetime(2026, 1, 1)
LONG = "Words that fill a section of an ordinance until it is long enough to be taken as one. " * 2
XML = '<DIV1 N="21" TYPE="TITLE"><HEAD>Title 21—Food and Drugs</HEAD><DIV5 N="117" TYPE="PART"><HEAD>PART 117—GOOD PRACTICE</HEAD><DIV8 N="117.3" TYPE="SECTION"><HEAD>§ 117.3 Definitions</HEAD><P>Food means food.</P></DIV8></DIV5></DIV1>'
PART = '<DIV5 N="11" TYPE="PART"><HEAD>PART 11—RECORDS</HEAD><DIV8 N="11.1" TYPE="SECTION"><HEAD>§ 11.1 Scope</HEAD><P>Records are kept.</P></DIV8></DIV5>'
TAC = "https://texreg.sos.state.tx.us/public/readtac$ext."
RULE = TAC + "TacPage?sl=R&app=9&p_dir=&p_rloc=16&p_tloc=&p_ploc=&pg=1&p_tac=&ti=16&pt=&ch=5&rl="
ELAWS = "http://dallascounty-tx.elaws.us/code/"
PAGES = {
    "https://www.ecfr.gov/api/versioner/v1/full/2026-01-01/title-21.xml": f"<ECFR>{XML}</ECFR>",
    "https://www.ecfr.gov/api/versioner/v1/full/2026-01-01/title-21.xml?part=11": PART,
    "https://www.ecfr.gov/api/versioner/v1/full/2026-01-01/title-7.xml": "<other/>",
    W.STATUTES + "PE/htm/PE.toc.htm": '<a href="PE.30.htm">30</a><a href="pe.2.htm">2</a><a href="PE.30.htm">again</a>',
    W.STATUTES + "PE/htm/PE.30.htm": '<a href="PE.30.10.htm">b</a><a href="PE.30.02.htm">a</a><a href="PE.30.77.htm">gone</a>',
    W.STATUTES + "PE/htm/PE.30.02.htm": "<h2>Burglary</h2><article>A person commits an offense. (a) if he enters, (b) if he stays.</article>",
    W.STATUTES + "PE/htm/PE.30.10.htm": "<article>short</article>",
    TAC + "ViewTAC?tac_view=3&ti=16": '<a href="v?ch=5">5</a><p>Chapter 9</p>',
    TAC + "ViewTAC?tac_view=4&ti=16&ch=5": '<a href="v?rl=5.1">x</a>',
    RULE + "5.1": '<h1>§ 5.1 - Scope</h1><div class="rule-text"><p>This rule governs the licensing of carriers.</p></div>',
    ELAWS + "coor": '<div class="toc-item"><a href="s1.htm">Chapter 2 Sec. 2.02</a></div><div class="toc-item"><a href="s2.htm">Chapter 2 Sec. 2.03</a></div>',
    ELAWS + "s1.htm": f"<h1>Flood</h1><div class='content'>{LONG}</div>",
    ELAWS + "s2.htm": "<h1>None</h1>",
    "https://library.municode.com/tx/plano/codes/code_of_ordinances": "# Chapter 1 General\n\n## Sec. 1-1. Name\n\nThis is the code of the city.\n\n## Sec. 1-2. Void\n\nx\n",
}
CODES = {W.STATUTES + "PE/htm/PE.2.htm": RuntimeError("HTTP 429"), TAC + "ViewTAC?tac_view=4&ti=16&ch=9": RuntimeError("401")}


def site(pages, codes):
    """A nested function, so that it reaches the workers by value."""

    def get(url):
        if url in codes:
            raise codes[url]
        if url not in pages:
            raise retry.NotFound(url)
        return pages[url]

    return get


get = site(PAGES, CODES)


@pytest.fixture
def run(spark, tmp_path):
    control = Control(spark, str(tmp_path))
    return lambda family, wanted, get=get, **more: A.index_family(spark, family, get, P.HashEmbedder(8), control, F.lit(NOW), 2026, "2026-01-01", wanted, spacing=0.0, retries=0, **more)


def _status(r):
    return {x["source_id"]: (x["chunks"], x["vectors"], x["failed"], x["status"]) for x in r.by_source.collect()}


def _lost(r):
    return sorted((x["source_id"], x["stage"], x["reason"].split(":")[0]) for x in r.rejected.collect())


def test_federal(spark, run, tmp_path):
    r = run("cfr", ["21", "Agriculture", "9"])
    assert [(x["vec_id"], x["source_type"], x["jurisdiction"], x["citation"], x["title"], x["text"], x["category"]) for x in r.index.collect()] == [
        ("cfr-21-117-117.3-0", "federal", "US", "21 C.F.R. § 117.3", "Definitions", "Food means food.", "food-safety")
    ]
    assert _status(r) == {"cfr-title-21": (1, 1, 0, "active"), "cfr-title-7": (0, 0, 1, "error"), "cfr-title-9": (0, 0, 1, "error")}
    assert _lost(r) == [("cfr-title-7", "parse", "neither a title nor a part"), ("cfr-title-9", "fetch", "404")]
    assert not r.total.first()["success"]
    one = spark.createDataFrame([(21, "11")], "number int, part string")
    found, bad = W.regulations(A.sources(spark, "cfr", ["21"]), W.Crawl(Control(spark, str(tmp_path)), "parts", get, spacing=0.0, retries=0), "2026-01-01", one)
    assert [(x["title"], x["part"], x["section"], x["text"]) for x in found.collect()] == [("21", "11", "11.1", "Records are kept.")] and bad.isEmpty()


def test_statutes(run):
    r = run("tx-statute", ["PE"])
    assert [(x["vec_id"], x["citation"], x["url"], x["title"]) for x in r.index.collect()] == [
        ("tx-statute-PE-30-30.02-0", "Tex. Penal Code Ann. § 30.02 (West 2026)", W.STATUTES + "PE/htm/PE.30.02.htm", "Burglary")
    ]
    assert _lost(r) == [("tx-statute-PE", "chapter", "429"), ("tx-statute-PE", "parse", "text too short")] and _status(r) == {"tx-statute-PE": (1, 1, 2, "partial")}


def test_rules(run):
    r = run("tx-tac", ["16"])
    assert [(x["vec_id"], x["title"], x["text"], x["category"]) for x in r.index.collect()] == [("tx-tac-16-5-5.1-0", "Scope", "This rule governs the licensing of carriers.", "alcohol")]
    assert _lost(r) == [("tx-tac-16", "chapter", "401")]


def test_counties(run):
    r = run("county", ["Dallas", "Harris"])
    assert [(x["jurisdiction"], x["citation"], x["text"], x["category"]) for x in r.index.collect()] == [("TX-48113", "Dallas County, Tex., Code of Ordinances sect. 2.02 (2026)", LONG.strip(), "subdivision")]
    assert _status(r) == {"county-dallas": (1, 1, 1, "partial"), "county-harris": (0, 0, 1, "error")}


def test_cities_merge_and_batch(spark, run, tmp_path):
    r = run("municipal", ["Plano", "austin"])
    rows = r.index.collect()
    assert [(x["jurisdiction"], x["title"], x["text"], x["category"]) for x in rows] == [("TX-plano", "Plano Code of Ordinances - 1-1.", "This is the code of the city.", "municipal-ordinance")]
    assert _status(r) == {"municipal-austin": (0, 0, 1, "error"), "municipal-plano": (1, 1, 1, "partial")}
    old = r.index.withColumns({"text": F.lit("old"), "last_updated": F.lit(NOW - dt.timedelta(days=1))})
    merged, bad = A.merge_index(old, [r], 8)
    assert [x["text"] for x in merged.collect()] == ["This is the code of the city."] and bad.isEmpty() and A.merge_index(None, [r], 9)[1].count() == 1
    statuses = spark.createDataFrame([("municipal-plano", "pending", 7)], "source_id string, status string, vectors long")
    assert {x["source_id"]: (x["status"], x["vectors"]) for x in pipelines.sync_status(statuses, r).collect()} == {"municipal-plano": ("error", 1), "municipal-austin": ("error", 0)}
    options = {"get": get, "embedder": P.HashEmbedder(8), "now": F.lit(NOW), "year": 2026, "date": "2026-01-01", "wanted": ["plano"], "spacing": 0.0, "retries": 0}
    runs, errors = A.index_all(spark, ["municipal", "none"], Control(spark, str(tmp_path / "all")), **options)
    assert _status(runs["municipal"]) == {"municipal-plano": (1, 1, 1, "partial")} and set(errors) == {"none"}


def test_resume(spark, tmp_path):
    """Levels without failures are held; one that failed is fetched anew with all that follows it."""
    urls = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    control, asked = Control(spark, str(tmp_path / "c")), tmp_path / "asked"
    asked.mkdir()

    def counted(url):
        (asked / f"{url}-{len(list(asked.iterdir()))}").touch()
        if url == "b" and len(list(asked.iterdir())) < 4:
            raise RuntimeError("403")
        return "" if url == "c" else url

    made = lambda: W.Crawl(control, "r", counted, spacing=0.0, retries=0)
    first = made()
    assert {(x["url"], x["http"]) for x in first.pages("one", urls("a", "c")).collect()} == {("a", 200), ("c", 204)} and first.pages("two", urls("b")).first()["http"] == 401
    again = made()
    again.pages("one", urls("a"))
    assert not again.anew and again.pages("two", urls("b")).first()["body"] == "b" and again.anew
    assert sorted(p.name.split("-")[0] for p in asked.iterdir()) == ["a", "b", "b", "c"]


def test_codes(spark):
    rows = spark.createDataFrame([("missing", None, "not found"), ("failed", None, "Limited: "), ("failed", None, "X: Unauthorized"), ("failed", None, "TimeoutError: "), ("ok", " ", None), ("cached", "x", None)], "status string, body string, error string")
    assert [x["http"] for x in N.typed(rows).collect()] == [404, 429, 401, 500, 204, 200]


def test_rule_pages(spark):
    clutter = "<nav>menu</nav><div class='breadcrumb'><p>crumb</p></div>"
    pages = [
        f"<body><strong>§ 5.1 - Scope</strong><div class='tac-body'>{clutter}<p>One rule.</p><p> </p><div class='paragraph'>Two rules.</div></div></body>",
        f"<h2>Fees</h2><main>{clutter}A fee  of\nten dollars is due on the first day of the month.</main>",
        "<body><div class='menu'>no</div><article>short</article> Only the body holds\n the text.</body>", None,
    ]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    good, bad = H.parse_rules(rows)
    assert [(r["heading"], r["text"]) for r in good.orderBy("i").collect()] == [("Scope", "One rule.\n\nTwo rules."), ("Fees", "A fee of ten dollars is due on the first day of the month."), ("", "short Only the body holds the text.")]
    assert [r["i"] for r in bad.collect()] == [3]


def test_markdown_blocks(spark):
    md = "Chapter 3\n=========\n\n1.01 Set\n--------\ntext a\n\n```\n# 9.9 not a heading\n- raw\n```\n\n---\n\n* item\n\n## Part IV\n\n### Sec. 4.01 Next\n\nbody long enough\n## Article General\nmore"
    pages = spark.createDataFrame([("a", md), ("b", "no heading"), ("c", "## 1. One\nx\n## 2. Two\ny\n## 3. Three\nlong enough text")], "id string, markdown string")
    rows = M.ordinances(pages, "id")
    assert [tuple(r) for r in rows.where("id = 'a'").orderBy("section").collect()] == [
        ("a", "3", "1.01", "Set", "text a\n\n# 9.9 not a heading\n- raw\n\n- item"), ("a", "IV", "4.01", "Next", "body long enough\nmore")
    ]
    assert {r["id"]: r["warning"] for r in M.warnings(pages, M.issues(rows), "id").collect()} == {"b": "no sections", "c": "only 1 of 3 sections are valid"}


def test_reports(spark):
    rows = spark.createDataFrame([("x", "1", "a" * 4, 2, 0), ("x", "1", "b" * 8, 2, 1), ("x", None, "c" * 4, 1, 0)], "county string, section string, chunk_text string, total_chunks int, chunk_index int")
    got = C.stats(rows, "county", section=("county", "section"), rounded=True).first()
    assert (got["total_chunks"], got["total_tokens"], got["avg_tokens"], got["split_sections"], got["sections"]) == (3, 7, 2, 1, 2)
    report = {"jurisdiction": "US", "source_type": "federal", "chunks": 8, "citation_coverage": 50, "avg": 3, "min": 1, "max": 9, "p50": 3, "p95": 9, "p99": 9, "has_category": 1, "has_title": 8, "has_last_updated": 0}
    page = Q.quality_markdown(report, [("c-1", "no citation")], "now")
    assert page.startswith("# Data Quality Report: US (federal)\n\n**Generated:** now\n\n## Summary\n\n- **Total Chunks:** 8\n") and "| Category | 1 | 12.5% |" in page and "| c-1 | no citation |" in page and "| Median (p50) | 3 |" in page
    assert "No validation issues found." in Q.quality_markdown({**report, "chunks": 0}, [], "now")
    enabled = [{"name": "Harris", "fips": "48201", "platform": "municode", "status": "active", "sections": 3, "vectors": 4}, {"name": "Dallas", "fips": "48113", "platform": "elaws", "status": "error"}]
    page = Q.coverage_markdown("County", "Counties", "fips", enabled, [], "now")
    assert "| Total Vectors | 4 |" in page and "| Dallas | 48113 | elaws | error | - | - |" in page and "None - all target counties enabled." in page and "## Failed Counties\n\n| County | FIPS | Error |\n|--------|------|-------|\n| Dallas | 48113 | Unknown error |" in page
