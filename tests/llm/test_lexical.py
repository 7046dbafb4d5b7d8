import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quillspan.llm import lexical as L, terms as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(T.TERM, (text or "").translate(LOWER))


def brute(docs, items, k=20):
    found = [(i, Counter(words(t)), len(words(t))) for i, t in docs]
    N, total = sum(n > 0 for *_, n in found), sum(n for *_, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in found:
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * N // total))) for t in words(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        scores.sort(key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scores[:k])]
    return out


def test_terms_are_those_of_the_expression():
    texts = ["", "CafÉ ÄB-c_d 1.5\x00x", "中文,AİZ `q`", "\x85  ok", "...", None]
    data = [(t or "").encode() for t in texts]
    at = np.cumsum([0, *map(len, data)])
    raw = np.frombuffer(b"".join(data), np.uint8)
    w, h = T.hashed(raw, at)
    got = [[raw[s:e].tobytes().decode().translate(LOWER) for s, e, d in zip(w.starts, w.ends, w.doc, strict=True) if d == i] for i in range(len(texts))]
    assert got == [words(t) for t in texts]
    assert len(set(h.tolist())) == len({x for ws in got for x in ws})


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_the_best_of_all_documents(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        n, t, leaf = int(rng.integers(1, 300)), int(rng.integers(1, 12)), int(2 ** rng.integers(0, 6))
        m = np.where(rng.random((t, n)) < 0.4, rng.integers(1, 20, (t, n)), 0)
        rows, docs = np.nonzero(m)
        sizes = np.bincount(rows, minlength=t)
        tree = L.DualSorted.of(np.flatnonzero(sizes).astype(np.uint64), np.cumsum(sizes[sizes > 0]), docs, m[rows, docs], n, leaf)
        asked = np.unique(rng.integers(0, t + 2, 4))
        w, k = rng.integers(0, 5, len(asked)), int(rng.integers(1, 30))
        d, s, _ = tree.search(asked.astype(np.uint64), w, k)
        want = sum((m[a] * v for a, v in zip(asked, w, strict=True) if a < t), np.zeros(n, int))
        assert sorted(zip(-s, d, strict=True))[:k] == sorted((-v, i) for i, v in enumerate(want) if v > 0)[:k]


def test_bounds_leave_subtrees_closed():
    n = 4096
    common, rare = np.arange(n), np.array([5, 6])
    tree = L.DualSorted.of(np.array([1, 2], np.uint64), np.array([n, n + 2]), np.concatenate([common, rare]), np.concatenate([np.ones(n, int), [900, 800]]), n)
    d, _, leaves = tree.search(np.array([1, 2], np.uint64), np.array([1, 1]), 2)
    assert set(d) == {5, 6} and leaves < 20


@pytest.mark.parametrize(("shard", "most"), [(7, 2_000_000), (4096, 2_000_000), (16, 3)])
def test_ranked(spark, shard, most):
    rnd = random.Random(shard)
    vocab = [f"w{i}" for i in range(30)] + ["The", "Été", "café"]
    docs = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(0, 40)))) for i in range(150)]
    docs += [(1000 + i, "same words here w1 w2") for i in range(40)] + [(3, docs[3][1]), (None, "w1 w2 w3"), (2000, None), (2001, ""), (2002, "--- ..."), (2003, "long w7 " * 20_000)]
    items = [(0, "w1 W2 w2 same"), (1, "the ÉTÉ café w7"), (2, None), (3, "absent"), (4, ""), (5, "w1 W2 w2 same"), (6, "words here"), (6, "words here")]
    d = spark.createDataFrame([(i, t, "own", 1) for i, t in docs], "doc_id long, text string, terms string, k1 int").repartition(4)
    b = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int")
    got = [tuple(r) for r in L.ranked(d, b, shard=shard, most_terms=most).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=repr) == sorted(brute(docs, items), key=repr)


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one, item = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert L.ranked(d, b).collect() == L.ranked(one, b).collect() == L.ranked(d, item).collect() == []
    assert [tuple(r) for r in L.ranked(one, item).collect()] == [(1, 1, 1, math.floor(1000 * math.log(4 / 3)) * (1_000_000_000 // (1000 + 12 * 100)))]
