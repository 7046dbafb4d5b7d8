"""The near_dedup stage's representatives against plain Jaccard similarity."""

import random

from test_pipeline import fp, sets

from quillspan.llm import simhash


def brute(texts):
    prints, shingles, parent = [fp(t) for t in texts], [sets(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    alike = []
    for i in range(len(texts)):
        for j in range(i):
            bits, like = (prints[i] ^ prints[j]).bit_count(), len(shingles[i] & shingles[j]) >= 0.8 * len(shingles[i] | shingles[j])
            alike += [bits] if like else []
            if bits <= 4 or like:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i for i in range(len(texts)) if root(i) == i}, alike


def changed(rnd, words, times):
    out = list(words)
    for i in range(times):
        out[(i + 1) * len(out) // (times + 1)] = f"n{rnd.random()}"
    return out


def kept(spark, texts, of=simhash):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"] for r in of.representatives(docs).collect()}


def test_pairs_beyond_ten_bits(spark):
    rnd, texts = random.Random(3), []
    for i in range(60):
        base = [f"w{rnd.randrange(5000)}" for _ in range(300)]
        texts += [" ".join(base), " ".join(changed(rnd, base, 6))]
    want, alike = brute(texts)
    assert max(alike) > 10
    assert kept(spark, texts) == want


def test_pairs_among_templates(spark):
    rnd, texts = random.Random(5), []
    common = [f"t{i}" for i in range(230)]
    for i in range(150):
        own = common + [f"w{rnd.randrange(10**6)}" for _ in range(40)]
        texts += [" ".join(own), " ".join(changed(rnd, own, 5))]
    want, _ = brute(texts)
    assert 1 < len(want) < len(texts)
    assert kept(spark, texts) == want
