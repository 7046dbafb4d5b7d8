"""Documents as objects: keys, pushed filters, partitions, and crawls that store and read them."""

import time

import pytest

from quillspan.functions import retry
from quillspan.operators.control import Control
from quillspan.plans import families as A
from quillspan.sources import crawl as W, objects as O
from tests.test_families import get, site

TEMPLATE = "cfr/title-{title}/part-{part}.xml"


@pytest.fixture
def kept(spark, tmp_path):
    rows = [(str(t), f"{p}", f"body {t}.{p}") for t in (7, 21) for p in (1, 10, 11, 2)] + [("21", "a/b §", "odd"), ("21", "3", None), ("21", "", "no place"), (None, "1", "none")]
    O.put(spark.createDataFrame(rows, "title string, part string, body string"), str(tmp_path), TEMPLATE)
    return str(tmp_path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_is_stored_is_read(spark, kept, tmp_path):
    rows = O.stored(spark, kept, TEMPLATE).collect()
    assert {(r["title"], r["part"]): r["body"] for r in rows} == {(str(t), str(p)): f"body {t}.{p}" for t in (7, 21) for p in (1, 10, 11, 2)} | {("21", "a/b §"): "odd"}
    one = next(r for r in rows if r["title"] == "7" and r["part"] == "1")
    assert one["key"] == "cfr/title-7/part-1.xml" and one["size"] == len("body 7.1") and abs(one["stored_at"].timestamp() - time.time()) < 600
    O.put(spark.createDataFrame([("7", "1", "new")], "title string, part string, body string"), kept, TEMPLATE)
    assert O.stored(spark, kept, TEMPLATE).where("title = '7' and part = '1'").first()["body"] == "new"
    assert not [p for p in tmp_path.rglob("*.tmp")]
    assert O.stored(spark, f"{kept}/nothing", TEMPLATE).collect() == []
    with pytest.raises(Exception, match="no column part"):
        O.ObjectWriter({"path": kept, "template": TEMPLATE}, spark.createDataFrame([("7", "1")], "title string, body string").schema)


def test_filters_reach_the_listing(spark, kept):
    rows = O.stored(spark, kept, TEMPLATE, partition_bytes=1)
    assert rows.rdd.getNumPartitions() == 9  # an object each
    cases = [("title = '21'", 5), ("title = '21' and part in ('1', '11', '99')", 2), ("part like '1%'", 6), ("title = '9'", 0), ("title is not null and part = 'a/b §'", 1), ("title in ('7') and title = '21'", 0)]
    for where, n in cases:
        got = rows.where(where)
        assert got.count() == n and "Filter (" not in _plan(got) and got.rdd.getNumPartitions() <= max(n, 1)
    mixed = rows.where("title = '7' and size > 8")
    assert mixed.count() == 2 and "Filter (" in _plan(mixed) and mixed.rdd.getNumPartitions() == 4
    assert rows.where("title = '21' or part = '1'").count() == 6 and rows.count() == 9


def test_values_never_leave_their_folder():
    row = {"title": "../x", "part": "a/b%"}
    key = O.key_of(TEMPLATE, row)
    assert key.count("/") == TEMPLATE.count("/") and ".." not in key.split("/")


def _crawl(spark, tmp_path, name, get, **more):
    return W.Crawl(Control(spark, str(tmp_path / name)), name, get, store=str(tmp_path / "store"), spacing=0.0, retries=0, **more)


def test_sections_from_the_store_are_those_of_the_crawl(spark, tmp_path):
    def gone(url):
        raise retry.NotFound(url)

    titles = A.sources(spark, "cfr", ["21"])
    parts = spark.createDataFrame([(21, 11)], "number int, part int")
    for key, family, rows, more in (
        ("cfr", "cfr", lambda c: W.regulations(titles, c, "2026-01-01", parts), {"title": "21", "part": ["11"]}),
        ("pe", "tx-statute", lambda c: W.statutes(A.sources(spark, "tx-statute", ["PE"]), c), {"code": "PE", "chapter": "30"}),
        ("tac", "tx-tac", lambda c: W.rules(A.sources(spark, "tx-tac", ["16"]), c), {}),
        ("county", "county", lambda c: W.counties(A.sources(spark, "county", ["Dallas"]), c), {}),
        ("city", "municipal", lambda c: W.cities(A.sources(spark, "municipal", ["plano"]), c), {"city_id": "plano"}),
    ):
        crawl = _crawl(spark, tmp_path, key, get)
        want = rows(crawl)[0]
        texts = sorted(r["text"] for r in want.collect())
        found, _ = W.from_store(spark, str(tmp_path / "store"), family, A.sources(spark, family), **more)
        assert texts and sorted(r["text"] for r in found.collect()) == texts
        assert W.from_store(spark, str(tmp_path / "store"), family, A.sources(spark, family, ["none"]))[0].collect() == []


def test_cities_ask_the_store_before_the_site(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def counted(url):
        (asked / str(len(list(asked.iterdir())))).touch()
        return get(url)

    city = A.sources(spark, "municipal", ["plano"])
    first = W.cities(city, _crawl(spark, tmp_path, "a", counted))[0].collect()
    again = W.cities(city, _crawl(spark, tmp_path, "b", counted))[0].collect()  # another run, the same store
    assert first and [r["text"] for r in first] == [r["text"] for r in again] and len(list(asked.iterdir())) == 1
    W.cities(city, _crawl(spark, tmp_path, "c", counted, now=time.time() + 8 * 86_400))[0].collect()
    assert len(list(asked.iterdir())) == 2


def test_old_levels_are_fetched_again(spark, tmp_path):
    urls = spark.createDataFrame([("a",)], "url string")
    control = Control(spark, str(tmp_path))
    page = lambda text, **more: W.Crawl(control, "r", site({"a": text}, {}), spacing=0.0, retries=0, **more).pages("top", urls).first()["body"]
    assert [page("one"), page("two"), page("two", days=7), page("three", days=7, now=time.time() + 6 * 86_400), page("three", days=7, now=time.time() + 8 * 86_400)] == ["one", "one", "one", "one", "three"]
