"""Bucketed tables, joins of many questions and keyed streams."""

import os
import random
import shutil
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.operators import buckets as B, retrieval as R
from quillspan.plans import pipelines
from quillspan.streaming import ingest as I

SCHEMA = "k int, v string, at int"


def _files(path):
    return {p.parent.name: p.name for p in Path(path).glob("rows/bucket=*/part-*")}


def _plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def _rows(t):
    return sorted((tuple(r) for r in t.rows().drop("bucket").collect()), key=repr)


def test_a_change_rewrites_its_own_buckets(spark, tmp_path):
    t = B.Buckets(spark, str(tmp_path / "t"), ["k"], 32)
    rows = [(i, f"v{i}", 1) for i in range(300)] + [(None, "null key", 1)]
    t.create(spark.createDataFrame(rows, SCHEMA))
    assert _rows(t) == sorted(rows, key=repr) and t.digests().count() == 32
    before = _files(t.path)
    own = t.upsert(spark.createDataFrame([(7, "new", 2), (8, "older", 0), (999, "added", 1), (7, "older still", 0)], SCHEMA), ["at"])
    after = _files(t.path)
    assert len(own) <= 3 and {n for n in after if after[n] != before[n]} == {f"bucket={n}" for n in own}
    want = {r[0]: r for r in rows} | {7: (7, "new", 2), 999: (999, "added", 1)}
    assert _rows(t) == sorted(want.values(), key=repr)
    assert t.upsert(spark.createDataFrame([], SCHEMA), ["at"]) == []
    t.delete(spark.createDataFrame([(None,), (7,), (12345,)], "k int"))
    del want[None], want[7]
    assert _rows(t) == sorted(want.values(), key=repr)


def test_buckets_may_become_empty(spark, tmp_path):
    t = B.Buckets(spark, str(tmp_path / "t"), ["k"], 4)
    t.create(spark.createDataFrame([(i, "x", 1) for i in range(3)], SCHEMA))
    t.delete(spark.createDataFrame([(i,) for i in range(9)], "k int"))
    assert _rows(t) == [] and t.digests().count() == 0
    t.upsert(spark.createDataFrame([(5, "again", 1)], SCHEMA), ["at"])
    assert _rows(t) == [(5, "again", 1)]
    none = B.Buckets(spark, str(tmp_path / "n"), ["k"], 4)
    none.create(spark.createDataFrame([], SCHEMA))
    assert _rows(none) == [] and sorted(tuple(r) for r in none.changes(t).collect()) == [(5, "added")]


def test_changes_read_differing_buckets_only(spark, tmp_path):
    rows = [(i, f"v{i}", 1) for i in range(2000)] + [(None, "n", 1)]
    a, b = (B.Buckets(spark, str(tmp_path / n), ["k"], 64) for n in "ab")
    a.create(spark.createDataFrame(rows, SCHEMA))
    b.create(spark.createDataFrame(rows, SCHEMA))
    assert a.differing(b) == [] and a.changes(b).collect() == []
    b.upsert(spark.createDataFrame([(3, "w", 2), (4000, "new", 1), (4, None, 2)], SCHEMA), ["at"])
    b.delete(spark.createDataFrame([(5,), (None,)], "k int"))
    own = a.differing(b)
    assert 0 < len(own) <= 5 and {r[0] for r in a.rows(own).select("bucket").distinct().collect()} == {*own}
    assert "bucket#" in _plan(a.rows(own)).split("PartitionFilters: [")[1].split("]")[0]
    assert sorted((tuple(r) for r in a.changes(b).collect()), key=repr) == sorted([(3, "changed"), (4, "changed"), (5, "removed"), (4000, "added"), (None, "removed")], key=repr)
    shutil.rmtree(f"{b.path}/digests/bucket={a.differing(b)[0]}")  # as an interrupted change leaves it
    assert a.differing(b) == own
    with pytest.raises(ValueError, match="other keys"):
        a.differing(B.Buckets(spark, a.path, ["k"], 32))


def _brute(index, questions, k):
    out = []
    for q, v, may in questions:
        if q is None or not v or len(v) != 8 or not any(v):
            continue
        unit = np.array(v) / np.linalg.norm(v)
        found = []
        for i, x, tag in index:
            if i is not None and x is not None and len(x) == 8 and None not in x and any(x) and (may is None or tag in may):
                found.append((-round(float(unit @ (np.array(x) / np.linalg.norm(x))), 6), i))
        out += [(q, i, -s, r + 1) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [32 << 20, 1000])
def test_every_question_gets_its_nearest(spark, block_bytes):
    rnd = random.Random(5)
    tags = ["US", "TX", "TX-1", None]
    vec = lambda: [float(rnd.randint(-3, 3)) for _ in range(8)]  # noqa: E731  many ties
    index = [(i, vec(), rnd.choice(tags)) for i in range(1500)] + [(9001, None, "US"), (9002, [0.0] * 8, "US"), (9003, [1.0], "US"), (None, vec(), "US"), (9004, [1.0] * 7 + [None], "US")]
    questions = [(i, vec(), rnd.choice([None, ["US"], ["US", "TX"], [], ["none"]])) for i in range(60)] + [(500, [0.0] * 8, None), (501, None, None), (None, vec(), None)]
    d = spark.createDataFrame(index, "vec_id long, embedding array<double>, jurisdiction string").repartition(3)
    q = spark.createDataFrame(questions, "question_id long, vector array<double>, may array<string>")
    got = sorted(tuple(r) for r in R.top_k_join(d, q, 5, allowed="may", block_bytes=block_bytes).collect())
    want = _brute(index, questions, 5)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])
    assert R.top_k_join(d, q.where("false"), 5).collect() == [] == R.top_k_join(d.where("false"), q, 5).collect()


def test_questions_are_shared_out_among_tasks(spark):
    """An index in one task is searched by several, no question passes through the driver, and infinite vectors have no rows."""
    rng = np.random.default_rng(2)
    vec = lambda: [float(v) for v in rng.normal(size=8)]
    index = [(i, vec(), "US") for i in range(300)] + [(900, [float("inf")] * 8, "US")]
    questions = [(i, vec(), None) for i in range(1000)]
    d = spark.createDataFrame(index, "vec_id long, embedding array<double>, jurisdiction string").coalesce(1)
    q = spark.createDataFrame(questions, "question_id long, vector array<double>, may array<string>").coalesce(1)
    found = R.top_k_join(d, q, 3, allowed="may")
    assert found.select(F.spark_partition_id()).distinct().count() > 4
    got = sorted(tuple(r) for r in found.collect())
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in _brute(index[:300], questions, 3)]


def _windows(rows):
    """Columns that reach the plan's windows."""
    plan = rows._jdf.queryExecution().optimizedPlan()
    found, open_ = [], [plan]
    while open_:
        node = open_.pop()
        if node.nodeName() == "Window":
            below = node.children().apply(0).output()
            found.append({below.apply(i).name() for i in range(below.size())})
        open_ += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_only_the_final_rows_carry_texts(spark):
    """Fifty rows a question are ranked by numbers; texts and vectors are joined to the few that stay."""
    d = spark.sql("SELECT id AS vec_id, array(1D, cast(id AS double)) AS embedding, 'US' AS jurisdiction, concat('text ', id) AS text, date'2025-01-01' AS last_updated FROM range(40)")
    q = spark.sql("SELECT id AS question_id, array(1D, cast(id AS double)) AS vector, array('US') AS may FROM range(1, 5)")
    got = R.retrieve_join(d, q, F.lit("2025-02-01").cast("timestamp"), final=3, allowed="may")
    assert all(not {"text", "embedding"} & w for w in _windows(got))
    best = got.where("position = 1").select("question_id", "vec_id", "text", "weighted").collect()
    assert sorted(map(tuple, best)) == [(i, i, f"text {i}", 1.0) for i in range(1, 5)]


def test_only_the_final_rows_of_prompts_carry_texts(spark):
    d = spark.sql("SELECT id AS vec_id, array(1D, cast(id AS double)) AS embedding, 'US' AS jurisdiction, 'cfr' AS source_type, 'c' AS citation, cast(null AS string) AS title, concat('text ', id) AS text, date'2025-01-01' AS last_updated FROM range(40)")
    q = spark.sql("SELECT id AS question_id, 'q' AS question, array(1D, cast(id AS double)) AS vector, array('US') AS may FROM range(1, 5)")
    got = pipelines.prompts(d, q, F.lit("2025-02-01").cast("timestamp"), allowed="may", final=1)
    assert all(not {"text", "embedding"} & w for w in _windows(got))
    assert all(f"text {r['question_id']}\n" in r["prompt"] for r in got.collect())


def test_equal_rows_go_by_id_when_pairs_are_scored_in_parts(monkeypatch):
    monkeypatch.setattr(R, "PAIRS", 50)
    x = np.tile(np.eye(4)[:1], (3000, 1))
    best = R.Best(3, 7)
    R.best_of(np.eye(4)[[0, 0, 1]], {None: np.ones(3, bool)}, x, np.array([""] * 3000, object), np.arange(3000)[::-1], best)
    assert best.id.tolist() == [*range(7)] * 3 and best.score.tolist() == [1.0] * 14 + [0.0] * 7


def test_far_blocks_are_not_multiplied():
    rng = np.random.default_rng(0)
    centres = np.eye(16)[:8]
    x = np.repeat(centres, 2000, axis=0) + rng.normal(0, 0.01, (16_000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = x[rng.permutation(len(x))]
    q = centres[:4]
    best = R.Best(4, 10)
    made = R.best_of(q, {None: np.ones(4, bool)}, x, np.array([""] * len(x), object), np.arange(len(x)), best)
    assert made < 0.6 * 4 * len(x)
    for j in range(4):
        want = sorted((-s, i) for i, s in enumerate(np.round(x @ q[j], 6)))[:10]
        assert [(-s, i) for s, i in zip(best.score[best.question == j], best.id[best.question == j])] == want


def test_a_stream_keeps_a_digest_a_key(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "state"))

    def put(rows, name, time):
        spark.createDataFrame(rows, "doc_id int, text string").coalesce(1).write.parquet(str(tmp_path / "one"))
        os.makedirs(src, exist_ok=True)
        for f in (tmp_path / "one").glob("part-*"):
            shutil.move(str(f), f"{src}/{name}.parquet")
            os.utime(f"{src}/{name}.parquet", (time, time))
        shutil.rmtree(tmp_path / "one")

    def run():
        I.ingest_keyed(I.read_sections(spark, src, "doc_id int, text string"), out, ck).awaitTermination()
        return sorted((tuple(r) for r in I.latest(spark, out).select("doc_id", "chunk_text", "version").collect()), key=repr)

    put([(1, "one"), (2, "two"), (3, None)], "a", 1_700_000_000)
    assert run() == [(1, "one", 1), (2, "two", 1), (3, None, 1)]
    put([(1, "one"), (2, "two b"), (3, None), (2, "two c")], "b", 1_700_000_100)
    second = run()
    assert second == [(1, "one", 1), (2, "two c", 2), (3, None, 1)]
    last = max(Path(ck, "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in Path(ck, "commits").glob(f"*{last.name}*"):
        p.unlink()  # the batch is repeated, as after a failure before its commit
    assert run() == second and spark.read.parquet(out).count() == 4
    put([(2, "two")], "c", 1_700_000_200)
    assert run() == [(1, "one", 1), (2, "two", 3), (3, None, 1)]


def test_a_stream_holds_its_keys_by_buckets(spark, tmp_path):
    """Python is called once a bucket and batch, however many keys there are; any kind of key, null among them, comes back as it was."""
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "state"))
    keys = spark.range(2500).selectExpr("cast(if(id = 0, null, 9007199254740993 + id) as long) AS doc_id", "concat('text ', id) AS text", "id")
    seen = []
    for rows in (keys, keys.withColumn("text", F.when(F.col("id") % 10 == 0, "new").otherwise(F.col("text"))), keys.limit(0)):
        rows.drop("id").write.mode("append").parquet(src)
        query = I.ingest_keyed(I.read_sections(spark, src, "doc_id long, text string"), out, ck)
        query.awaitTermination()
        seen += [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(seen) <= I.BUCKETS
    got = sorted(((r["doc_id"], r["chunk_text"], r["version"]) for r in spark.read.parquet(out).collect()), key=str)
    name = lambda i: 9007199254740993 + i if i else None
    assert got == sorted([(name(i), f"text {i}", 1) for i in range(2500)] + [(name(i), "new", 2) for i in range(0, 2500, 10)], key=str)


def test_other_kinds_of_keys_come_back_from_a_stream(spark, tmp_path):
    rows = spark.sql("SELECT named_struct('a', 'x\"\\\\ny', 'b', timestamp'2025-01-01 10:00:00.123456') AS doc_id, 'one' AS text")
    rows.write.parquet(str(tmp_path / "in"))
    I.ingest_keyed(I.read_sections(spark, str(tmp_path / "in"), rows.schema), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).select("doc_id").collect() == rows.select("doc_id").collect()


def test_waiting_rows_below_the_best_are_not_sorted(monkeypatch):
    sizes, sort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sizes.append(len(keys[0])) or sort(keys))
    best = R.Best(1, 10)
    best.least[0] = 0.5
    zeros = np.zeros(200, np.int64)
    best.add(zeros, np.round(np.linspace(-1, 1, 200), 6), np.arange(200))
    assert sizes == [50] and best.id.tolist() == [*range(199, 189, -1)]
    best.add(zeros[:3], np.array([1.0, 1.0, 0.999999]), np.array([500, 7, 6]))
    assert best.id.tolist() == [7, 199, 500, 6, *range(198, 192, -1)]
