"""Sites, fetching, control state, family chunks, runs, routes and the command line on small fixtures."""

import datetime as dt
import json

from pyspark.sql import functions as F

from quillspan import __main__ as cli
from quillspan.functions import retry
from quillspan.operators import chunk as C, store as S
from quillspan.operators.control import Control
from quillspan.plans import api, pipelines, providers as P, registry
from quillspan.sources import dom, fetch as N, html as H, platforms as L

WORDS = "word " * 40


def test_selectors():
    page = dom.parse('<nav class="toc x"><ul><li><a id="k" href="q?nodeId=1">A<br>B</a></ul></nav><p data-section="">C</p><script>no</script>')
    assert [e.text() for e in page.select("nav.toc a")] == ["AB"] and page.select('a[href*="nodeId"]') and page.select("#k") and not page.select("nav.y a")
    assert [e.tag for e in page.select("[data-section], br")] == ["br", "p"] and page.text("nav") == "C"


def test_sites(spark):
    toc = '<div class="toc-item"><a href="ch10.htm">Chapter 10 Roads</a></div><div class="toc-item"><a href="/x/s.htm">Chapter 2 Sec. 2.02</a><a href="http://h/">Home</a><a href="/x/s.htm">again</a></div>'
    rows = [("elaws", "http://d.us/code/coor", toc), ("amlegal", "http://c/x/overview", '<a data-node-id="SEC_4.2" href="n4">Drains</a>'), ("municode", "http://m/base", '<a class="toc-link" href="/c?nodeId=3">3. Fire</a><a class="toc-link" href="s">Search this</a>'), ("custom", "http://z", toc), ("elaws", "http://d.us/code/coor", None)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, platform string, base_url string, html string")
    links = [[(x["url"], x["chapter"], x["section"]) for x in r[0]] for r in pages.orderBy("i").select(L.contents(F.col("html"), F.col("base_url"), F.col("platform"))).collect()]
    assert links == [[("http://d.us/x/s.htm", "2", "2.02"), ("http://d.us/code/ch10.htm", "10", "0")], [("http://c/x/n4", "0", "4.2")], [("http://m/c?nodeId=3", "3", "3.")], [], []]
    assert [r["error"] for r in L.checked(pages).orderBy("i").collect()] == [None, None, None, "no layout for platform", "source not accessible"]
    got = [
        (1, "elaws", f'<h1>Flood</h1><div class="content"><nav>menu</nav>{WORDS}</div>', "t", "1.2"), (2, "municode", f'<div class="chunk-content"><h2>Sec. 3-1 Name</h2><p>{WORDS}</p><p>b</p></div>', "t", None),
        (3, "amlegal", "<body>short</body>", "t", "1"), (4, "custom", WORDS, "t", "1"), (5, "municode", None, None, None), (6, "amlegal", f"<body><p>a  b</p>{WORDS}<nav>x</nav></body>", "Title", "9"),
    ]
    good, bad = L.ordinances(spark.createDataFrame(got, "i int, platform string, html string, title string, section string"))
    assert [(r["i"], r["section"], r["heading"], r["text"]) for r in good.orderBy("i").collect()] == [
        (1, "1.2", "Flood", WORDS.strip()), (2, "3-1", "Sec. 3-1 Name", WORDS.strip() + "\n\nb"), (6, "9", "Title", "a b" + WORDS.strip())
    ]
    assert {r["i"]: r["reason"] for r in bad.collect()} == {3: "insufficient content", 4: "no layout for platform", 5: "insufficient content"}
    assert L.adapter(registry.counties(spark), "dallas").spacing == 1.0 and L.adapter(registry.counties(spark), "Nowhere") is None
    rules = spark.range(1).select(H.chapter_rules(F.lit('<a href="v?ti=1&rl=5.10">x</a><td>§ 5.9 text, § 6.1</td><li>Section 5.31</li>'), "5")).first()[0]
    assert rules == ["5.10", "5.31", "5.9"]


def test_fetching(spark, tmp_path):
    get = N.FileFetcher(str(tmp_path))
    get.path("http://a/1").write_text("one")
    urls = spark.createDataFrame([("http://a/1",), ("http://a/2",), ("http://b/1",), ("http://a/1",), (None,)], "url string")

    def fails(url):
        if url.startswith("http://b"):
            raise retry.Limited("0")
        return get(url)

    rows = {r["url"]: (r["status"], r["body"]) for r in N.fetch(urls, fails, spacing=0.01, retries=1, base=0.0).collect()}
    assert rows == {"http://a/1": ("ok", "one"), "http://a/2": ("missing", None), "http://b/1": ("failed", None)}
    now = dt.datetime(2025, 1, 10)
    cache = spark.createDataFrame([("http://a/1", "old", now - dt.timedelta(days=9)), ("http://a/2", "held", now - dt.timedelta(days=1))], "url string, body string, stored_at timestamp")
    keep = lambda df: (df.write.parquet(str(tmp_path / "new")), spark.read.parquet(str(tmp_path / "new")))[1]
    got = {r["url"]: (r["status"], r["body"]) for r in N.read_through(urls, cache, get, keep, F.lit(now), spacing=0.0).collect()}
    assert got == {"http://a/1": ("ok", "one"), "http://a/2": ("cached", "held"), "http://b/1": ("missing", None)}
    assert N.snapshot_date('{"meta": {"date": "2025-01-02"}}', now.date()) == "2025-01-02" and N.snapshot_date("x", now.date()) == "2025-01-03"
    tree = json.dumps({"type": "title", "children": [{"type": "chapter", "children": [{"type": "part", "identifier": "117"}, {"type": "subchapter", "children": [{"type": "part", "identifier": "11"}]}]}, {"type": "part", "identifier": "x"}]})
    docs = spark.createDataFrame([(tree,), ("{",), (None,)], "body string")
    assert [r["parts"] for r in N.title_parts(docs).collect()] == [[11, 117], [], []]
    titles = spark.createDataFrame([('{"titles": [{"number": 21, "name": "Food"}]}',)], "body string")
    assert [tuple(r) for r in N.title_list(titles).collect()] == [(21, "Food")]


def test_control(spark, tmp_path):
    c = Control(spark, str(tmp_path))
    assert c.get("a/b") is None and not c.delete("a/b") and c.keys("a") == []
    c.put("a/b", {"x": 1})
    c.put("a/b", {"x": 2})
    assert c.required("a/b") == {"x": 2} and c.exists("a/b") and c.keys("a") == ["a/b"]
    (tmp_path / "bad.json").write_text("{")
    assert c.get("bad") is None
    c.checkpoint("federal", "21", 117, ["118"])
    assert c.resume("federal", "21")["last"] == 117 and not c.finish("federal", "21")
    c.checkpoint("federal", "21", 200)
    assert c.finish("federal", "21") and c.resume("federal", "21") is None
    for title, parts in ((21, 2), (7, 1), (21, 3)):
        entries = c.manifest("cfr", "title", {"title": title, "parts": parts})
    assert entries == [{"title": 7, "parts": 1}, {"title": 21, "parts": 3}]
    assert c.load_step("r", "s") is None and c.save_step("r", "s", spark.range(3)).count() == 3 and c.load_step("r", "s").count() == 3 and c.clear("r") and c.load_step("r", "s") is None


def test_family_chunks(spark):
    long = "start (a) " + "x" * 4000 + " (b) " + "y" * 4000
    tx = spark.createDataFrame([("HS", "Health & Safety Code", "Health & Safety Code", "431", "431.002", long)], "code string, code_name string, cited_as string, chapter string, section string, text string")
    got = C.family_chunks(tx, "tx-statute", 2026).orderBy("chunk_index").collect()
    assert [(r["chunk_id"], r["citation"], r["hierarchy"][3], r["total_chunks"]) for r in got] == [
        (f"tx-statute-HS-431-431.002-{i}", f"Tex. Health & Safety Code Ann. § 431.002 (West 2026) ({s})", f"Section 431.002 ({s})", 2) for i, s in enumerate("ab")
    ]
    us = spark.createDataFrame([("21", "I", "117", "117.5", "short"), ("21", "I", "117", "abc", "short")], "title string, chapter string, part string, section string, text string")
    assert sorted((r["chunk_id"], r["citation"] or "") for r in C.family_chunks(us, "cfr", 2026).collect()) == [("cfr-21-117-117.5-0", "21 C.F.R. § 117.5"), ("cfr-21-117-abc-0", "")]
    city = spark.createDataFrame([("plano", "Plano", "1", "1-1", "a"), ("plano", "Plano", "1", "1-2", "b")], "city_id string, city string, chapter string, section string, text string")
    assert [(r["chunk_index"], r["total_chunks"]) for r in C.family_chunks(city, "municipal", 2026).orderBy("section").collect()] == [(0, 2), (1, 2)]


def test_tables(spark):
    old = spark.createDataFrame([(1, "t", 5), (2, "u", 6)], "k int, title string, n int")
    new = spark.createDataFrame([(1, None, 7), (3, "v", None)], "k int, title string, n int")
    assert sorted(tuple(r) for r in S.patched(old, new, "k").collect()) == [(1, "t", 7), (2, "u", 6), (3, "v", None)]
    assert S.matching(old, k=1, title=None).count() == 1 and S.matching(old, k=1, title="u").count() == 0
    thread, said = S.saved_query("q" * 51, "a", 9, None, "c1")
    assert thread[0]["title"] == "q" * 50 + "..." and [m["role"] for m in said] == ["user", "assistant"] and S.saved_query("q", "a", 9, "c0", "c1")[0][0]["title"] is None
    hit, missing = S.covering_batches(old, old.where("k = 1").select("k", "n").withColumnRenamed("n", "v"), "k", ["k"], 1)
    assert [r["batch"] for r in hit.collect()] == [0] and [r["k"] for r in missing.collect()] == [2]
    assert P.embedding_stats(65) == {"rows": 65, "embed_batches": 2, "upsert_batches": 1} and P.embeddable(spark.createDataFrame([("x" * 40000,), ("y",)], "text string"))[1].count() == 1


def _sections(spark):
    rows = [("county", "county-harris", "TX-48201", "1", "Fire lanes stay clear."), ("county", "county-travis", "TX-48453", "1", "z" * 9000), ("county", "county-travis", "TX-48453", "2", "ok"), ("municipal", "municipal-plano", "TX-plano", "1", " ")]
    return spark.createDataFrame(rows, "source_type string, source_id string, jurisdiction string, section_id string, text string")


def _chunks(spark):
    rows = [("US", "federal", "21 C.F.R. § 1", "t", "food", "one", 10), ("TX-48201", "county", "", None, None, "two", 30)]
    return spark.createDataFrame(rows, "jurisdiction string, source_type string, citation string, title string, category string, text string, tokens long")


def test_routes(spark, tmp_path):
    now = dt.datetime(2025, 1, 10)
    parts = lambda title: spark.createDataFrame([(21, 1, "<a/>"), (21, 2, "<b/>")], "title int, part int, xml string").where(F.lit(title is None) | (F.col("title") == F.lit(title)))
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "x.xml").write_text("<x/>")
    s = api.Service(spark, Control(spark, str(tmp_path / "control")), P.HashEmbedder(8), F.lit(now), _sections(spark), _chunks(spark), str(tmp_path / "docs"), str(tmp_path / "cache"), parts)
    assert s.call("GET", "/health")[1]["status"] == "ok" and s.call("GET", "/none")[0] == 404
    assert [r["content_type"] for r in s.call("GET", "/documents")[1].collect()] == ["application/xml"]
    assert [tuple(r) for r in s.call("POST", "/cache/federal/refresh")[1].collect()] == [(21, "stored", 2)]
    s.now = F.lit(now + dt.timedelta(days=8))
    assert [tuple(r) for r in s.call("POST", "/cache/federal/refresh/21")[1].collect()] == [(21, "unchanged", 2)]
    assert [tuple(r) for r in s.call("GET", "/cache/federal/status")[1].collect()] == [(21, 2, 192.0, True)]
    status, rows = s.call("POST", "/pipeline/counties")
    assert status == 207 and {r["source_id"]: (r["chunks"], r["vectors"], r["failed"], r["status"]) for r in rows.collect()} == {"county-harris": (1, 1, 0, "active"), "county-travis": (2, 1, 1, "partial")}
    assert s.call("POST", "/pipeline/counties/Harris")[0] == 200 and s.call("POST", "/pipeline/municipal/plano")[0] == 500 and s.call("POST", "/pipeline/federal/99")[0] == 404
    old = spark.createDataFrame([("county-harris", "pending", 7)], "source_id string, status string, vectors long")
    assert {r["source_id"]: r["status"] for r in pipelines.sync_status(old, s.runs["counties"]).collect()} == {"county-harris": "active", "county-travis": "error"}
    assert s.call("GET", "/workflows/counties/status")[1]["status"] == "partial" and s.call("POST", "/workflows/counties/pause")[0] == 501 and s.call("GET", "/workflows/none/status")[0] == 404
    assert s.call("POST", "/pipeline/municipal/reset")[1] == {"cleared": 1}
    assert s.call("GET", "/pipeline/counties/status")[1].where("is_indexed").count() == 1 and s.call("POST", "/pipeline/counties/validate")[0] == 501
    assert {r["source_type"]: r["indexed"] for r in s.call("GET", "/validation/coverage")[1].collect()} == {"federal": 7, "state": 0, "county": 1, "municipal": 0}
    assert s.call("GET", "/validation/quality")[1].count() == 2 and s.call("GET", "/validation/report")[1].where("p50 = 30").count() == 1
    assert s.call("GET", "/validation/summary")[1]["gaps"] == 56


def test_command(spark, tmp_path, capsys):
    _chunks(spark).drop("tokens").write.parquet(str(tmp_path / "c"))
    assert cli.main([str(tmp_path / "c"), "--format", "json", "--output", str(tmp_path / "out.json")]) == 1
    assert set(json.loads((tmp_path / "out.json").read_text())) == {"Coverage", "Gaps", "Quality", "Total"}
    assert cli.main([str(tmp_path / "c"), "--coverage-only"]) == 0 and "# Gaps" in capsys.readouterr().out


def test_question(spark):
    e, now = P.HashEmbedder(8), dt.datetime(2025, 1, 1)
    texts = ["what about food?", "unrelated", "city rule"]
    rows = [(i, [float(x) for x in e([t])[0]], j, st, f"cite {i}", None, t, now) for i, (t, j, st) in enumerate(zip(texts, ["US", "US", "TX-plano"], ["federal", "federal", "municipal"]))]
    index = spark.createDataFrame(rows, "vec_id int, embedding array<float>, jurisdiction string, source_type string, citation string, title string, text string, last_updated timestamp")
    got = pipelines.answer_question(spark, index, texts[0], F.lit(now), e, P.EchoGenerator())
    assert got["jurisdictions"] == ["US"] and [c["vec_id"] for c in got["chunks"]][0] == 0 and got["citations"][0]["citation"] == "cite 0" and got["warnings"] == [] and got["sections"][0]["level"] == "federal"
    assert got["confidence"]["level"] in ("High", "Medium", "Low")
    none = pipelines.answer_question(spark, index, "zzz", F.lit(now), e, lambda p: "Nothing [1].", address="x", geocode=lambda a: {"state": "TX"}, min_score=2.0)
    assert none["chunks"] == [] and none["jurisdictions"] == ["US", "TX"] and none["citations"] == [] and len(none["warnings"]) == 1
