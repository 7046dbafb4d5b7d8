import hashlib
import math

import numpy as np
import pytest

from quillspan.llm import clusters as C


def lloyd(rows, k, rounds, seed=3, scale=1024):
    """Plain rounds in Python integers: [(vec_id, cluster, distance)] and the centroids."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    cent = [list(v) for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(near(v)[1], []).append(v)
        for j, vs in own.items():
            cent[j] = [sum(col) // len(vs) for col in zip(*vs, strict=True)]
    return [(i, near(v)[1], near(v)[0]) for i, v in kept], cent


def test_trees_cover_their_points():
    x = np.random.default_rng(0).integers(-50, 50, (3000, 5))
    t = C.cover_tree(x, leaf=4, fan=6)
    assert (t.points == x[t.order]).all() and sorted(t.order) == list(range(3000))
    for v in range(len(t.radius)):
        own = t.points[t.first[v] : t.last[v]]
        assert C._apart(own.astype(float), t.points[t.centre[v]].astype(float)).max() <= t.radius[v] + 1e-9
        if t.children[v]:
            kids = range(t.child[v], t.child[v] + t.children[v])
            assert [t.first[u] for u in kids] == [t.first[v], *[t.last[u] for u in kids][:-1]] and t.last[kids[-1]] == t.last[v]


@pytest.mark.parametrize("seed", range(6))
def test_pairs_of_nodes_lose_no_nearest_centroid(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        n, dims, k = rng.integers(1, 300), rng.integers(1, 4), rng.integers(1, 40)
        x = rng.integers(-3, 4, (n, dims)) * int(rng.integers(1, 99))
        cent = rng.integers(-3, 4, (k, dims)) * int(rng.integers(1, 99))
        t = C.cover_tree(x, leaf=int(rng.integers(1, 20)), fan=int(rng.integers(2, 9)))
        node, of, _ = C.assign(t, cent)
        for v in np.flatnonzero(node >= 0):
            assert (of[t.first[v] : t.last[v]] == -1).all()
            of[t.first[v] : t.last[v]] = node[v]
        assert (of == ((t.points[:, None] - cent[None]) ** 2).sum(2).argmin(1)).all()


def test_far_groups_are_never_compared():
    rng = np.random.default_rng(1)
    cent = rng.integers(-10_000, 10_000, (8, 16))
    x = np.repeat(cent, 200, axis=0) + rng.integers(-20, 20, (1600, 16))
    _, _, made = C.assign(C.cover_tree(x), cent)
    assert made == 0


@pytest.mark.parametrize("block", [7, 8192])
def test_clusters_are_those_of_plain_rounds(spark, block):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(rng.integers(0, 3), 0.4, 4)]) for i in range(120)] + [(500 + i, [0.5, 0.25, -0.5, 1.0]) for i in range(60)]
    rows += [rows[3]] * 9 + [(None, [0.1, 0.2, 0.3, 0.4])]
    odd = [(900, None), (901, [1.0]), (902, [1.0, 2.0, None, 3.0]), (903, [1.0, float("nan"), 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0, 0.0]), (905, [])]
    df = spark.createDataFrame([(i, v, "own") for i, v in rows + odd], "vec_id long, embedding array<float>, cluster string").repartition(5)
    got = C.clusters(df, k=5, rounds=4, dims=4, block=block)
    want, cent = lloyd(rows, 5, 4)
    out = got.collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in out), key=key) == sorted(want, key=key)
    for r in out:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"]) and r["inertia"] == sum(d for *_, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, cent[r["cluster"]])).encode()).hexdigest()


def test_few_and_no_vectors(spark):
    kind = "vec_id long, embedding array<float>"
    assert C.clusters(spark.createDataFrame([], kind), dims=2).collect() == []
    assert C.clusters(spark.createDataFrame([(1, None)], kind), dims=2).collect() == []
    out = C.clusters(spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], kind), dims=2).collect()
    assert {(r["vec_id"], r["distance"], r["inertia"]) for r in out} == {(1, 0, 0), (2, 0, 0), (3, 0, 0)}
    assert len({r["cluster"] for r in out}) == 2  # of equal centroids the smaller number
    with pytest.raises(Exception, match="64 bits"):
        C.clusters(spark.createDataFrame([(1, [1e9, 0.0])], kind), dims=2).collect()
