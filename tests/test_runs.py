"""Runs that go on: starts by route, options of steps, limited providers, typed errors."""

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillspan.functions import retry
from quillspan.operators.control import Control
from quillspan.plans import api, families as A, pipelines, providers as P
from tests.test_families import NOW, get
from tests.test_service import _chunks, _sections


def counting(root, fails=None):
    """An embedder that leaves a file for each call, with its texts; a class made here reaches the workers by value."""

    class Counting(P.HashEmbedder):
        def __call__(self, texts):
            Path(root).mkdir(exist_ok=True)
            before = [p.read_text().split("|") for p in Path(root).iterdir()]
            Path(root, uuid.uuid4().hex).write_text("|".join(texts))
            if fails:
                fails(texts, before)
            return P.HashEmbedder(self.dimensions)(texts)

        def calls(self):
            return sorted(p.read_text() for p in Path(root).iterdir()) if Path(root).exists() else []

    return Counting(8)


def _service(spark, tmp_path, e, **more):
    now = F.lit(dt.datetime(2025, 1, 10))
    return api.Service(spark, Control(spark, str(tmp_path / "control")), e, now, _sections(spark), _chunks(spark), "", "", lambda t: None, **more)


def test_a_second_start_embeds_nothing(spark, tmp_path):
    e = counting(tmp_path / "calls")
    s = _service(spark, tmp_path, e)
    assert s.call("POST", "/pipeline/counties")[0] == 207
    first = e.calls()
    status, rows = s.call("POST", "/pipeline/counties")
    assert first and e.calls() == first and status == 207 and rows.count() == 2
    assert s.call("GET", "/workflows/counties/status")[1]["status"] == "partial"


def test_routes_run_families(spark, tmp_path):
    e = counting(tmp_path / "calls")
    s = _service(spark, tmp_path, e, get=get, date="2026-01-01", fetching={"spacing": 0.0, "retries": 0})
    status, rows = s.call("POST", "/pipeline/texas/statutes/PE")
    assert status == 207 and {r["source_id"]: (r["vectors"], r["status"]) for r in rows.collect()} == {"tx-statute-PE": (1, "partial")}
    assert s.call("POST", "/pipeline/municipal/plano")[0] == 207 and s.call("POST", "/pipeline/federal/99")[0] == 404
    before = e.calls()
    assert s.call("POST", "/pipeline/municipal/plano")[0] == 207 and e.calls() == before
    assert s.call("POST", "/pipeline/municipal/reset")[1] == {"cleared": 1}
    assert s.call("POST", "/pipeline/municipal/plano")[0] == 207 and len(e.calls()) == len(before) + 1


def test_other_options_make_other_steps(spark, tmp_path):
    e = counting(tmp_path / "calls")
    control = Control(spark, str(tmp_path / "c"))
    run = lambda year, wanted: A.index_family(spark, "tx-statute", get, e, control, F.lit(NOW), year, "2026-01-01", wanted, spacing=0.0, retries=0)
    # the code's crawl loses a page, so its levels are fetched again each time: only a whole crawl is held
    cities = lambda year: A.index_family(spark, "municipal", get, e, control, F.lit(NOW), year, "2026-01-01", ["plano"], spacing=0.0, retries=0)
    assert "2026" in cities(2026).index.first()["citation"]
    assert len(e.calls()) == 1 and "2026" in cities(2026).index.first()["citation"] and len(e.calls()) == 1
    assert "2027" in cities(2027).index.first()["citation"] and len(e.calls()) == 2
    assert run(2026, ["PE"]).index.count() == 1
    part = A.index_family(spark, "cfr", get, e, control, F.lit(NOW), 2026, "2026-01-01", ["21"], parts=[(21, 11)], spacing=0.0, retries=0)
    assert [r["citation"] for r in part.index.collect()] == ["21 C.F.R. § 11.1"]


def test_limited_rows_come_back_when_they_are_due(spark, tmp_path):
    def fails(texts, calls):
        times = sum(texts == c for c in calls)
        if "slow" in texts[0] and times < 2:
            raise retry.Limited("3" if times == 0 else None)
        if "never" in texts[0]:
            raise retry.Limited(None)
        if "broken" in texts[0]:
            raise RuntimeError("no")

    e = counting(tmp_path / "calls", fails)
    texts = ["good", "slow a", "never b", "broken c", " \n", None, "x" * 40_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(7, "id")
    time = {"now": 1000.0, "slept": []}

    def sleep(s):
        time["slept"].append(s)
        time["now"] += s

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # a call for each text
    try:
        good, bad = P.embedded(rows, e, Control(spark, str(tmp_path / "c")), "r", attempts=3, base=10.0, sleep=sleep, clock=lambda: time["now"])
        assert {r["id"] for r in good.where("size(embedding) = 8").collect()} == {0, 1}
        assert {r["id"]: r["error_code"] for r in bad.collect()} == {2: "RATE_LIMIT", 3: "API_ERROR", 4: "BLANK", 5: "BLANK", 6: "TOKEN_LIMIT"}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert e.calls() == ["broken c", "good", "never b", "never b", "never b", "slow a", "slow a", "slow a"]
    assert time["slept"][0] == pytest.approx(3.0) and all(s > 0 for s in time["slept"])


def test_errors_have_codes(spark):
    class Refused(Exception):
        status, type = 400, "invalid_request_error"

    class Busy(Exception):
        status = 429

    for error, code in ((Refused(), "CONTENT_FILTER"), (Busy(), "RATE_LIMIT"), (ValueError(), "API_ERROR"), (retry.Limited(), "RATE_LIMIT")):
        def generate(prompt, error=error):
            raise error

        with pytest.raises(P.ProviderError) as e:
            P.generated(generate, "p")
        assert e.value.code == code
    with pytest.raises(P.ProviderError, match="no text"):
        P.generated(lambda p: "", "p")
    index = spark.createDataFrame([], "vec_id int, embedding array<float>, jurisdiction string, source_type string, citation string, title string, text string, last_updated timestamp")
    with pytest.raises(P.ProviderError, match="no text"):
        pipelines.answer_question(spark, index, "q", F.lit(NOW), P.HashEmbedder(8), lambda p: "")


def test_urls_without_spacing_are_fetched_by_many_tasks(spark):
    from pyspark.sql import functions as F

    from quillspan.sources import fetch as N

    urls = spark.range(300).select(F.concat(F.lit("https://one.example/"), "id").alias("url"))
    tasks = lambda spacing: N.fetch(urls, lambda u: u[::-1], spacing=spacing).select(F.spark_partition_id()).distinct().count()
    assert tasks(0.0) > 4 and tasks(1e-6) == 1
    assert sorted(tuple(r) for r in N.fetch(urls, lambda u: u[::-1], spacing=0.0).collect()) == sorted((u, "ok", u[::-1], None) for u in (f"https://one.example/{i}" for i in range(300)))
