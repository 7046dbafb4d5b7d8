import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quillspan.llm import ppm, quality
from quillspan.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n", "a b c a b c a b c", "x\n\nx\n x\n\r\nx\ny\r\ny\r\n", "é\x85ü|<> #$\tz\x0bq", "the " * 4000, "l1 a\nl1 a\n\nl1 a ", "end"]


def lower(t):
    return (t or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))


def brute_base(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    cover = {i + k for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_base_counts(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()] + [(9000 + i, t) for i, t in enumerate(ODD)] + [(None, "a b")]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string"), None).select("doc_id", "quality_rules.*").collect()
    want = sorted((d if d is not None else -1, *brute_base(t)) for d, t in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, *r[1:6]) for r in got) == want
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) == (not r["kept"]) for r in got)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.quality_rules(empty, spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"), sample=1500)
    test = docs.join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = quality.judge(test, model).select("quality", "quality_rules.*").where("not base_failed").collect()
    right = sum((r["quality"] == 1) == r["kept"] for r in rows) / len(rows)
    good = [r for r in rows if r["quality"] == 1]
    assert right > 0.9 and sum(r["kept"] for r in good) / len(good) > 0.95


def brute_ppm(train, texts, order):
    """By the definition: escape with exclusion, over dictionaries."""
    levels = [defaultdict(Counter) for _ in range(order + 1)]
    for t in train:
        b = [ppm.START] * order + list(t) + [ppm.END]
        for i in range(order, len(b)):
            for k in range(order + 1):
                levels[k][tuple(b[i - k : i])][b[i]] += 1
    out = []
    for t in texts:
        b, total = [ppm.START] * order + list(t) + [ppm.END], 0.0
        for i in range(order, len(b)):
            gone = set()
            for k in range(order, -1, -1):
                c = levels[k].get(tuple(b[i - k : i]))
                if not c:
                    continue
                left = {s: n for s, n in c.items() if s not in gone}
                whole = sum(left.values()) + len(left)
                if b[i] in left:
                    total += math.log10(left[b[i]] / whole)
                    break
                if left:
                    total += math.log10(len(left) / whole)
                gone |= set(left)
            else:
                total -= math.log10(ppm.SYMBOLS - len(gone))
        out.append(total)
    return out


def test_scores_match_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 60").collect()]
    rows += [(9000 + i, t) for i, t in enumerate(ODD)] + [(None, "null id the"), (5, "the again")]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0 for d, _ in rows]
    train = [lower(t) for (_, t), h in zip(rows, held) if not h]
    c = Counter(w for t in train for w in t.split())
    n, v = sum(c.values()) + len(train), len(c) + 1
    want = []
    for (d, t), h, s in zip(rows, held, brute_ppm(train, [lower(t) for _, t in rows], ppm.ORDER)):
        w = lower(t).split()
        base = sum(math.log10((x + 0.1) / (n + 0.1 * (v + 1))) for x in [c[x] for x in w] + [len(train)])
        want.append((d if d is not None else -1, h, len(w) + 1, sum(c[x] > 0 for x in w) + 1, n, pytest.approx(base, rel=1e-9), pytest.approx(s, rel=1e-9)))
    got = ppm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    key = lambda r: (r[0], r[2], r[3])
    assert sorted([(r[0] if r[0] is not None else -1, *r[1:]) for r in got], key=key) == sorted(want, key=key)
    pruned = ppm.scores(spark.createDataFrame(rows, "doc_id long, text string"), most=1000).collect()
    assert sorted([(r[0] if r[0] is not None else -1, *r[1:6]) for r in pruned], key=key) == sorted([w[:6] for w in want], key=key)


def test_scores_keep_rare_sequences(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 40").collect()]
    rows += [(9000 + i, t) for i, t in enumerate(ODD)] + [(None, "null id the \u0416\u0416\u0416")]
    train = [lower(t) for d, t in rows if zlib.crc32(b"" if d is None else str(d).encode()) % 10]
    want = dict(zip([d for d, _ in rows], brute_ppm(train, [lower(t) for _, t in rows], ppm.ORDER)))
    for most in (10_000, 2, 0):
        got = {r["doc_id"]: r["score"] for r in ppm.scores(spark.createDataFrame(rows, "doc_id long, text string"), most=most).collect()}
        assert got == {d: pytest.approx(s, rel=1e-9) for d, s in want.items()}


def test_scores_of_nothing(spark):
    assert ppm.scores(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    one = ppm.scores(spark.createDataFrame([(None, "ab")], "doc_id long, text string")).collect()
    assert one[0]["n_known"] == 0 and one[0]["score"] == pytest.approx(-3 * math.log10(257))
