"""Runs of several children at once, and the natural order of section numbers."""

import re
import time

from pyspark.sql import functions as F

from quillspan.functions import text as T
from quillspan.operators import store as S
from quillspan.operators.control import Control
from quillspan.plans import families as A, providers as P
from quillspan.plans.graph import RunGraph
from tests.test_families import NOW, get


def test_a_cancelled_child_costs_the_others_nothing(spark, tmp_path):
    control = Control(spark, str(tmp_path))

    def slow():
        control.save_step("slow", "one", spark.range(3))
        wait = F.udf(lambda i: __import__("time").sleep(300) or i, "long")
        return spark.range(2).select(wait("id").alias("x")).agg(F.sum("x")).first()

    def quick():
        return control.save_step("quick", "one", spark.range(5)).count()

    def broken():
        control.save_step("broken", "one", spark.range(1))
        raise ValueError("no such page")

    g = RunGraph(spark, control, "all", together=3)
    for name, make in (("slow", slow), ("quick", quick), ("broken", broken)):
        g.add(name, make)
    began = time.time()
    g.start()
    while control.load_step("slow", "one") is None:
        time.sleep(0.2)
    time.sleep(1)
    assert g.cancel("slow") and g.wait(250) == {"slow": "cancelled", "quick": "complete", "broken": "error"} and time.time() - began < 280
    assert g.results() == {"quick": 5} and g.errors()["broken"] == "ValueError: no such page" and not g.cancel("quick")
    assert control.load_step("slow", "one") is None and control.load_step("quick", "one").count() == 5 and control.load_step("broken", "one").count() == 1
    assert control.get("runs/all/slow")["status"] == "cancelled" and control.get("runs/all/quick")["status"] == "complete"
    assert spark.range(4).count() == 4  # no tag stays behind


def test_families_run_at_once(spark, tmp_path):
    options = {"get": get, "embedder": P.HashEmbedder(8), "now": F.lit(NOW), "year": 2026, "date": "2026-01-01", "spacing": 0.0, "retries": 0}
    runs, errors = A.index_all(spark, ["municipal", "cfr", "none"], Control(spark, str(tmp_path)), together=2, wanted=["plano", "21"], **options)
    assert {k: r.index.count() for k, r in runs.items()} == {"municipal": 1, "cfr": 1} and set(errors) == {"none"}


def test_natural_keys_sort_as_numbers(spark):
    texts = ["12.9", "12.10", "12.10b", "12.10a", "12", "12.10.1", "", "a", "A1", "a10", "a9", "007", "7", "0", "00", "1" * 40, "9" * 39, "é2", "12-1"]
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    natural = lambda t: [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.findall(r"[0-9]+|[^0-9]+", t)]
    got = [r["t"] for r in rows.where("t is not null").orderBy(T.natural_key(F.col("t")), "t").collect()]
    assert got == sorted(texts, key=lambda t: (natural(t), t))
    keys = {r["t"]: r["k"] for r in rows.select("t", T.natural_key(F.col("t")).alias("k")).collect()}
    assert keys[None] is None and keys["7"] == keys["007"] and keys["0"] == keys["00"]


def test_ranks_over_ranges(spark):
    rows = [(i, (i * 7919) % 500 if i % 3 else 11) for i in range(3000)] + [(9000, None)]
    d = spark.createDataFrame(rows, "i int, k int")
    got = {r["i"]: r["rank"] for r in S.ranked(d, "k", parts=7).collect()}
    order = sorted((v is not None, v or 0) for _, v in rows)
    first = {v: n + 1 for n, v in reversed(list(enumerate(order)))}
    assert got == {i: first[v is not None, v or 0] for i, v in rows}
    assert S.ranked(d.where("false"), "k").collect() == []
