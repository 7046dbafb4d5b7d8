"""Golden values and small fixtures for functions, chunking, parsing, retrieval and tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillspan.functions import retry, text as T
from quillspan.operators import answer as A, chunk as C, coverage as V, quality as Q, retrieval as R, store as S
from quillspan.plans import providers as P, registry
from quillspan.sources import html as H, markdown as M, xml as X


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_citations_and_ids(spark):
    L = F.lit
    assert one(
        spark, T.federal_citation(L(21), L("117.5"), L("(a)")), T.federal_citation(L(21), L("abc")), T.statute_citation(L("Penal Code"), L("30.02"), 2026), T.rule_citation(L(16), L("5.31"), 2026),
        T.county_citation(L("Harris"), L("Code"), L("1.2"), 2026), T.city_citation(L("Houston"), L("1-2"), 2026), T.order_citation(L("Harris"), L("7"), F.lit("2026-03-15").cast("date")),
        T.chunk_id("county", L("Fort Bend"), L("3"), L("3.1"), L(0)), T.source_id("county", L("Fort Bend")), T.source_id("cfr", L(21)),
        T.ordinance_url("municipal", L("municode"), L("http://x"), L("Sec 1/2")), T.ordinance_url("county", L("amlegal"), L("http://x"), L("a b")), T.ordinance_url("county", L("elaws"), L("http://x"), L("")),
        T.tokens(L("x" * 397)), T.tokens(L("")), T.tokens(L("🙂" * 2)), T.city_key(L("St. Mary's  City")),
    ) == (
        "21 C.F.R. § 117.5(a)", None, "Tex. Penal Code Ann. § 30.02 (West 2026)", "16 Tex. Admin. Code § 5.31 (2026)", "Harris County, Tex., Code sect. 1.2 (2026)", "Houston, Tex., Code of Ordinances sect. 1-2 (2026)",
        "Harris County Commissioners Court Order No. 7 (Mar. 15, 2026)", "county-fort-bend-3-3.1-0", "county-fort-bend", "cfr-title-21", "http://x?nodeId=Sec%201%2F2", "http://x/codes/overview?nodeId=a%20b", "http://x", 111, 0, 2, "st-marys-city",
    )


def greedy(sizes, limit=1500, back=225):
    """Packing by its definition."""
    runs, cur, total = [], [], 0
    for i, n in enumerate(sizes, 1):
        if total + n > limit and cur:
            runs.append((cur[0], cur[-1]))
            keep, held = [], 0
            for j in reversed(cur):
                if held + sizes[j - 1] > back:
                    break
                keep.insert(0, j)
                held += sizes[j - 1]
            cur, total = keep, held
        cur.append(i)
        total += n
    return [*runs, (cur[0], cur[-1])] if cur else []


def test_packing(spark):
    import random

    rnd = random.Random(3)
    cases = [[rnd.choice([5, 60, 200, 230, 700, 1400, 2000]) for _ in range(rnd.randint(0, 30))] for _ in range(60)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, s array<long>")
    got = {r["i"]: [tuple(x) for x in r["r"]] for r in df.select("i", C.pack(F.col("s")).alias("r")).collect()}
    assert got == {i: greedy(c) for i, c in enumerate(cases)}


def test_chunk_tiers(spark):
    marked = "preamble dropped\n(a) " + "x" * 6000 + "\n(b)(2)(i) short body\n(c)   "
    rows = [(1, "x" * 5452), (2, marked), (3, "\n\n".join(["p" * 2400] * 4)), (4, "y" * 9000), (5, "")]
    got = C.chunk(spark.createDataFrame(rows, "k int, text string")).collect()
    by = {k: [(r["chunk_index"], r["total_chunks"], r["subsection"]) for r in got if r["k"] == k] for k in range(1, 6)}
    assert by[1] == [(0, 1, None)] and by[4] == [(0, 1, None)] and by[5] == [(0, 1, None)]
    assert by[2] == [(0, 2, "(a)"), (1, 2, "(b)(2)(i)")] and [x[0] for x in by[3]] == [0, 1]
    good, bad = C.oversize(C.chunk(spark.createDataFrame(rows, "k int, text string")))
    assert {r["k"] for r in bad.collect()} == {2, 4} and good.count() + bad.count() == len(got)


def test_percentiles_and_outliers(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4)], "tokens long")
    assert Q.floor_percentiles(df, "tokens").first()["p50"] == 3
    assert Q.outliers(spark.createDataFrame([(5,)] * 4, "tokens long")).count() == 0
    assert "| a |" in Q.markdown([{"a": 1}], "t")


def test_filters_and_confidence(spark):
    df = spark.createDataFrame([(1, "TX", "county"), (2, "US", "federal"), (3, "TX", "state")], "id int, j string, s string")
    ids = lambda spec: [r["id"] for r in df.where(R.compile_filter(spec)).orderBy("id").collect()]
    assert ids({"j": "TX"}) == [1, 3] and ids({"$or": [{"j": {"$eq": "US"}}, {"s": {"$in": ["state"]}}]}) == [2, 3] and ids({"j": "TX", "s": "state"}) == [3]
    none = R.confidence(spark.createDataFrame([], "score double, jurisdiction string, citation string"), ["US"]).first()
    assert none["level"] == "Low" and none["score"] == 0
    full = R.confidence(spark.createDataFrame([(0.9, "US", "c")], "score double, jurisdiction string, citation string"), ["US"]).first()
    assert full["level"] == "High" and full["reason"] == "High: 1/1 jurisdictions covered, avg similarity 0.90, 100% chunks have citations"
    now = dt.datetime(2025, 1, 1)
    found = spark.createDataFrame([(d, 0.5, now - dt.timedelta(days=d)) for d in (364, 365, 366)], "vec_id int, score double, last_updated timestamp")
    assert [r["weighted"] for r in R.rerank(found, F.lit(now)).collect()] == [0.6, 0.4, 0.4]


def test_answers(spark):
    text = (
        "### Federal Requirements\nMust register [2] and [1] and [2] [0] [99].\n### State Texas\nNone.\n### Required Permits and Licenses\n**Permit Name**: Food\n**Issuing Agency**: DSHS\n**Jurisdiction**: TX\n"
        "**Link**: https://x\n**Regulatory Reference**: 25 TAC\n\n**Permit Name**: Beer\n**Issuing Agency**: TABC\n**Jurisdiction**: TX\n**Regulatory Reference**: 16 TAC\n"
    )
    df = spark.createDataFrame([(1, text)], "k int, answer string")
    t, n = F.col("answer"), F.lit(3)
    r = df.select(A.references(t).alias("a"), A.valid_references(t, n).alias("v"), A.warnings(t, n).alias("w"), A.permits(t).alias("p")).first()
    assert r["a"] == [2, 1, 0, 99] and r["v"] == [1, 2] and r["w"] == ["Invalid citation references found: [0, 99] (references to non-existent chunks)"]
    assert [(p["name"], p["url"]) for p in r["p"]] == [("Food", "https://x"), ("Beer", None)]
    assert [(s["level"], s["name"], s["content"]) for s in A.sections(df, "k").collect()] == [("federal", "Federal", "Must register [2] and [1] and [2] [0] [99]."), ("state", "Texas", "None.")]


def test_parsers(spark):
    xml = '<ECFR><DIV1 TYPE="TITLE" N="27"><HEAD>Title 27—Alcohol</HEAD><DIV3 TYPE="CHAPTER"><DIV5 TYPE="PART" N="1"><HEAD>PART 1—BASIC</HEAD><DIV8 TYPE="SECTION" N="1.1"><HEAD>§ 1.1   General.</HEAD><FP>flush</FP><P>first</P><P>second</P></DIV8></DIV5></DIV3></DIV1></ECFR>'
    good, bad = X.parse(spark.createDataFrame([(1, xml), (2, "<x/>"), (3, "broken")], "id int, xml string"))
    assert [tuple(r) for r in good.collect()] == [(1, 27, "Alcohol", 1, "BASIC", "1.1", "General.", "first\n\nsecond\n\nflush")]
    assert sorted(r["id"] for r in bad.collect()) == [2, 3]
    page = '<body><h2 class="section-heading"> </h2><h2>Title</h2><div class="statute-body">Sec text (a) first body (b) second body\n\n\n\nCopyright 2020 x</div><a href="HS.2.htm">2</a><a href="HS.10.htm">10</a></body>'
    good, bad = H.parse_statutes(spark.createDataFrame([(1, page), (2, "<p>x</p>")], "id int, html string"))
    r = good.first()
    assert r["heading"] == "" or r["heading"] == "Title"
    assert r["text"] == "Sec text (a) first body (b) second body" and [s["id"] for s in r["subsections"]] == ["(a)", "(b)"] and bad.count() == 1
    assert one(spark, H.code_chapters(F.lit(page), "HS"))[0] == ["2", "10"]
    md = "# Chapter 3 General\nlost\n## Sec. 3-1. Purpose\nIntro (a) one thing (b) two\n- item\n\n# Chapter 4\n### 4.2 - Scope\n> quoted\n"
    rows = M.ordinances(spark.createDataFrame([("c", md)], "city string, markdown string"), "city").orderBy("section").collect()
    assert [(r["chapter"], r["section"], r["heading"], r["text"]) for r in rows] == [("3", "3-1.", "Purpose", "Intro (a) one thing (b) two\n- item"), ("4", "4.2", "Scope", "> quoted")]


def test_registries(spark):
    assert [registry.titles(spark).count(), registry.codes(spark).count(), registry.rules(spark).count(), registry.counties(spark).count(), registry.cities(spark).count()] == [7, 27, 5, 10, 20]
    assert {r["platform"]: r["sources"] for r in registry.platform_stats(registry.cities(spark)).collect()} == {"municode": 17, "amlegal": 3}
    assert registry.lookup(registry.counties(spark), "name", "fort bend", True).count() == 1
    expected = registry.expected_jurisdictions(spark)
    found = spark.createDataFrame([("US", 5)], "jurisdiction string, vectors long")
    assert V.flags(expected, found).where("is_indexed").count() == 7 and V.gaps(expected, found).count() == 57


def test_retry():
    assert [retry.delay(i) for i in range(5)] == [1, 2, 4, 8, 8]
    assert retry.retry_after("3", 0) == 3 and retry.retry_after("soon", 0) is None
    calls, waits = [], []

    def fail():
        calls.append(1)
        raise retry.NotFound if len(calls) > 2 else retry.Limited("5")

    with pytest.raises(retry.NotFound):
        retry.call(fail, sleep=waits.append)
    assert waits == [5, 5] and len(calls) == 3


def test_providers_and_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, " ")], "id int, text string")
    v = {r["id"]: r["embedding"] for r in P.embed(df, P.HashEmbedder(8)).collect()}
    assert set(v) == {1, 2} and abs(sum(x * x for x in v[1]) - 1) < 1e-5
    assert P.jurisdictions({"state": "TX", "fips": "48439", "city": "Fort Worth"}) == ["US", "TX", "TX-48439", "TX-fort_worth"] and P.jurisdictions(None) == ["US"]
    t = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "x")], "id int, v int, t string")
    assert sorted(r["t"] for r in S.last_write(t, ["id"], ["v"]).collect()) == ["new", "x"]


def test_stream(spark, tmp_path):
    from quillspan.streaming import ingest as I

    schema = "doc_id long, text string"
    for i, rows in enumerate([[(1, "a"), (2, "b")], [(1, "changed"), (2, "b")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        I.ingest(I.read_sections(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {r["doc_id"]: (r["chunk_text"], r["batch"]) for r in I.current(spark, str(tmp_path / "out")).collect()}
    assert got == {1: ("changed", 1), 2: ("b", 0)}


def test_replayed_batch_and_versions(spark, tmp_path):
    import os
    import shutil

    from quillspan.streaming import ingest as I

    schema, out, ck, src = "doc_id long, text string", str(tmp_path / "out"), str(tmp_path / "ck"), str(tmp_path / "in")

    def put(rows, name, at):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / name))
        os.makedirs(src, exist_ok=True)
        for f in (tmp_path / name).glob("part-*.parquet"):
            to = os.path.join(src, f"{name}.parquet")
            shutil.copy(f, to)
            os.utime(to, (at, at))

    def run():
        I.ingest(I.read_sections(spark, src, schema), out, ck).awaitTermination()
        return sorted((r["doc_id"], r["chunk_text"], r["batch"]) for r in I.current(spark, out).collect())

    put([(1, "zzz first"), (2, "two")], "a", 1_700_000_000)
    put([(1, "aaa second")], "b", 1_700_000_100)  # the later version, whatever its digest
    first = run()
    assert first == [(1, "aaa second", 0), (2, "two", 0)]
    os.remove(os.path.join(ck, "commits", "0"))  # the batch was written but not committed
    crc = os.path.join(ck, "commits", ".0.crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert run() == first
    put([(2, "two"), (3, "three")], "c", 1_700_000_200)
    assert run() == [*first, (3, "three", 1)]


def test_joined_overlap(spark):
    # 15 % of 100 tokens: what fits in 15 tokens is the overlap, and it is one paragraph from then on.
    t = lambda n, c: c * (n * 4)
    paragraphs = [t(80, "a"), t(5, "b"), "", t(5, "c"), t(70, "d"), t(9, "e"), t(60, "f"), t(95, "g")]
    text = "\n\n".join(p if p else "\x20" for p in paragraphs).replace("\x20", " ")

    def count(x):
        import math

        return math.ceil(math.ceil(len(x) / 4) * 1.1) if x else 0

    def brute(parts, limit, share):
        chunks, held, size = [], [], 0
        for p in parts:
            if size + count(p) > limit and held:
                chunks.append("\n\n".join(held))
                keep, total = [], 0
                for q in reversed(held):
                    if not q:
                        continue
                    if total + count(q) > int(limit * share):
                        break
                    keep.insert(0, q)
                    total += count(q)
                head = "\n\n".join(keep)
                held, size = ([head], count(head)) if head else ([], 0)
            held.append(p)
            size += count(p)
        return [*chunks, "\n\n".join(held)]

    import random

    rnd, texts = random.Random(1), [text, "", "one", "\n\nx\n\n" + t(99, "y") + "\n\n" + t(3, "z")]
    texts += ["\n\n".join(rnd.choice(["", " ", t(rnd.randrange(1, 60), rnd.choice("abc")), t(rnd.randrange(1, 9), "k")]) for _ in range(rnd.randrange(1, 40))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = rows.select("k", C.split_with_overlap(F.col("text"), 100, 0.15, r"\n\n+", True, joined=True).alias("c")).collect()
    import re

    for r in got:
        assert [c["text"] for c in r["c"]] == brute(re.split(r"\n\n+", texts[r["k"]]), 100, 0.15), r["k"]


def test_long_texts_are_packed_in_one_pass(spark):
    import time

    n = 100_000
    paragraph = lambda i: F.concat(F.lit("p"), F.lpad(i.cast("string"), 6, "0"), F.lit(" of a long text"))
    one = spark.range(1).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), paragraph), "\n\n").alias("text"))
    began = time.time()
    for joined in (False, True):
        got = one.select(F.explode(C.split_with_overlap(F.col("text"), joined=joined)).alias("c")).select("c.first", "c.last", F.length("c.text").alias("n")).orderBy("first").collect()
        assert got[0]["first"] == 1 and got[-1]["last"] == n and all(a["last"] >= b["first"] - 1 > a["first"] for a, b in zip(got, got[1:]))
    assert time.time() - began < 300  # seconds on an idle host
    nothing = spark.createDataFrame([(1, None), (2, "")], "k int, text string")
    assert [(r["k"], r["chunk_text"], r["total_chunks"]) for r in C.chunk(nothing).orderBy("k").collect()] == [(1, None, 1), (2, "", 1)]


def test_index_declared_once(spark, tmp_path):
    from quillspan.operators.control import Control

    control = Control(spark, str(tmp_path))
    assert S.create_index(control, "regulations", 64) == S.create_index(control, "regulations", 64)
    control.put("x", {"a": 1})
    control.put("x", {"a": 2})
    assert control.get("x") == {"a": 2}
    with pytest.raises(ValueError):
        S.create_index(control, "regulations", 32)


def _parsed_apart(parsed):
    """Tasks that rows come from, and how often the plan calls Python."""
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    first = plan.split("== Initial Plan ==")[-1]
    return parsed.select(F.spark_partition_id()).distinct().count(), first.count("ArrowEvalPython")


def test_statutes_of_one_task_are_parsed_by_many_and_once(spark):
    pages = spark.range(400).coalesce(1).select("id", F.concat(F.lit('<h2>Head</h2><div class="section-text">(a) long enough '), "id", F.lit("</div>")).alias("html"))
    good, _ = H.parse_statutes(pages)
    tasks, calls = _parsed_apart(good)
    assert tasks > 4 and calls == 1
    assert sorted(tuple(r) for r in good.select("id", "heading", "text").collect()) == [(i, "Head", f"(a) long enough {i}") for i in range(400)]


def test_rules_of_one_task_are_parsed_by_many_and_once(spark):
    pages = spark.range(400).coalesce(1).select("id", F.concat(F.lit('<h1>§5.1 - Head</h1><div class="rule-text"><p>(a) a text that is long enough '), "id", F.lit("</p></div>")).alias("html"))
    good, _ = H.parse_rules(pages)
    tasks, calls = _parsed_apart(good)
    assert tasks > 4 and calls == 1
    assert sorted(tuple(r) for r in good.select("id", "heading", "text").collect()) == [(i, "Head", f"(a) a text that is long enough {i}") for i in range(400)]


def test_sections_are_emptied_as_they_are_read():
    """A part's tree shrinks while its rows are made, and sections come one by one."""
    body = "".join(f'<DIV8 N="1.{i}" TYPE="SECTION"><HEAD>§ 1.{i} H{i}</HEAD><P>text {i}</P></DIV8>' for i in range(3))
    title, name, parts = X._parts(f'<DIV5 N="1" TYPE="PART"><HEAD>PART 1—GOODS</HEAD>{body}</DIV5>')
    rows = X._sections(title, name, parts)
    assert next(rows)["section"] == "1.0" and next(rows)["heading"] == "H1"
    assert [len(s) for s in parts[0].findall("DIV8")] == [0, 0, 2]
    assert [r["text"] for r in rows] == ["text 2"]


def test_documents_keep_their_columns_in_both_results(spark):
    good = "".join(f'<DIV8 N="{i}" TYPE="SECTION"><P>text {i}</P></DIV8>' for i in range(X.ROWS + 10))
    files = spark.createDataFrame([(1, f'<DIV5 N="1" TYPE="PART"><HEAD>PART 1</HEAD>{good}</DIV5>', "a"), (2, "<x", "b"), (3, "<x/>", None), (4, None, "d")], "n int, xml string, u string")
    found, bad = X.parse(files)
    assert found.groupBy("n", "u").count().collect() == [(1, "a", X.ROWS + 10)] and found.select("section").distinct().count() == X.ROWS + 10
    assert sorted((r["n"], r["u"]) for r in bad.collect()) == [(2, "b"), (3, None), (4, "d")]


def test_chunks_are_made_once(spark):
    """No filter of empty lists with copies of what makes them is moved below; a blank section has no chunk."""
    from quillspan.operators import chunk as C

    d = spark.createDataFrame([(1, "one"), (2, "\n \n" * 5000), (3, None)], "id int, text string")
    got = C.chunk(d)
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("ArrowEvalPython") == 1
    assert sorted(map(tuple, got.select("id", "chunk_index", "total_chunks", "chunk_text").collect())) == [(1, 0, 1, "one"), (3, 0, 1, None)]


def test_plain_pages_are_read_by_one_pattern(monkeypatch):
    """Whatever the page, the calls are HTMLParser's own; plain pages don't need it."""
    import random
    from html.parser import HTMLParser

    from quillspan.sources import dom

    class Calls(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.seen = []

        def handle_data(self, data):
            if self.seen and self.seen[-1][0] == "data":
                data = self.seen.pop()[1] + data
            self.seen.append(("data", data))

        handle_starttag = lambda self, tag, attrs: self.seen.append(("start", tag, attrs))
        handle_endtag = lambda self, tag: self.seen.append(("end", tag))

    rng = random.Random(3)
    plain = ["<p>", '<div class="a b" id="x">', "</p>", "</div>", "<br>", "</br>", "text > more\r\n ", "é ", "<h2>", "</h2>", '<a x="1" x="2">', "</titles>", '<a href="/a?b=1;c">']
    odd = ["<P>", "<br/>", "&amp;", "&amp", "<!-- c -->", "<script>", "</script>", "<title>", "</title>", "<", "a<b", "</p x='1'>", '</p x="1">', "<p class=a>", '<a x="&lt;">', "<!DOCTYPE html>", "<textarea>", "<style>", "</", "<p", "\x00", "<?x?>", '<p  a="1">', '<p a="1" >', "<a-b>", '<p a="1"b="2">', "<plaintext>", "<svg>", "</style>", '<a-b c="d">']
    for n in range(4000):
        html = "".join(rng.choices(plain if n % 3 == 0 else plain + odd, k=rng.randrange(12)))
        fast, slow = Calls(), Calls()
        dom.feed(fast, html)
        slow.feed(html)
        slow.close()
        assert fast.seen == slow.seen, html
    monkeypatch.setattr(HTMLParser, "feed", None)
    assert H.first_texts('<h2>Head</h2><div class="section-text">(a) x</div>', H.STATUTE_HEADINGS, H.STATUTE_TEXTS) == ["Head", "(a) x"]
    assert H.rule_of('<h1>§5.1 - Head</h1><div class="rule-text"><p>(a) x</p></div>') == {"heading": "Head", "text": "(a) x"}
