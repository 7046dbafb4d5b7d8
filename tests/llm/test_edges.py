"""Odd tables through every operator: extra columns whose names clash, nulls, repeated rows, very long texts, no rows."""

import public_tokenizers
import pytest

import corpus_pipeline as C
from quillspan.llm import decontam, mixing, ppm, quality, secret_scan, sharding, simhash, token_counts, token_files

SF = "/root/testdata/sf0.001"
BASE = " ".join(f"word{i}" for i in range(120))
#: Columns named like the operators' own.
NAMES = "row k1 k2 fp t size bits prefix label h key n copies times quality_rules shard slot start value token held_out kept r copy target rate".split()
ROWS = [(1, BASE), (1, BASE), (2, BASE.replace("word60 ", "other ")), (3, None), (4, ""), (None, "a null id with a few words"), (5, "long " * 50_000), (6, "\u00e9\u4e2d\U0001f600 \x85 x")]


def odd(spark, rows=ROWS):
    d = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return d.withColumns({n: simhash.F.lit(f"own {n}") for n in NAMES})


BENCH = [(0, BASE[:400]), (1, None), (2, "few words")]
OPERATORS = {
    "op1": lambda s, d: simhash.near_duplicates(d),
    "op2": lambda s, d: sharding.shards(d, 16),
    "op3": lambda s, d: quality.quality_rules(d, s.createDataFrame([(1, 1), (2, 0), (5, 0), (6, 1)], "doc_id long, quality int")),
    "op5": lambda s, d: mixing.mix(d)[1],
    "op6": lambda s, d: token_files.token_files(d, public_tokenizers.path("word_bpe_49k.json"), end_id=2),
    "op7": lambda s, d: ppm.scores(d),
    "op8": lambda s, d: decontam.contaminated(d, s.createDataFrame(BENCH, "item_id long, text string")),
    "op9": lambda s, d: secret_scan.secrets(d),
    "op10": lambda s, d: token_counts.token_counts(d, public_tokenizers.path("byte_bpe_50k.json"), limit=1024),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operator(spark, name):
    plain = spark.createDataFrame([(i, t, "s") for i, t in ROWS], "doc_id long, text string, source string")
    key = lambda rows: sorted(str([r[c] for c in sorted(r.asDict()) if c not in ("k1", "k2")]) for r in rows)
    got = OPERATORS[name](spark, odd(spark)).collect()
    want = OPERATORS[name](spark, plain).collect()
    if name == "op5":  # rates are rounded by the rows' hashes, which the extra columns are part of
        assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r["doc_id"]), r["size"]) for r in want)
    else:
        assert key(got) == key(want)
    if name not in ("op8", "op9"):
        assert len(got) == len(ROWS)
    assert OPERATORS[name](spark, odd(spark, [])).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_stage(spark, name):
    stage, docs = dict(C.STAGES)[name], odd(spark)
    out = stage(spark, docs, SF)
    rows = out.collect()
    if name != "sharding":
        assert out.columns == docs.columns
        assert {str(r) for r in rows} <= {str(r) for r in docs.collect()}
    ids = sorted(str(r["doc_id"]) for r in rows)
    if name == "quality_rules":  # no word, no document
        assert not {"3", "4"} & {*ids} and ids.count("1") in (0, 2)
    if name == "near_dedup":  # one of the equal rows and their near copy, one of the blank texts
        assert ids == ["1", "3", "5", "6", "None"]
    if name in ("decontamination", "sharding"):
        assert ids == sorted(str(i) for i, _ in ROWS)
    assert stage(spark, odd(spark, []), SF).collect() == []


def test_main_texts_of_odd_pages(spark):
    from quillspan.llm import html_extract

    page = "<html><body><nav>menu</nav><article><h1>T</h1><p>" + "word " * 40_000 + "</p></article></body></html>"
    rows = [(1, "http://a.org/x", page), (1, "http://a.org/x", page), (2, None, "<article><p>no url</p></article>"), (3, "http://a.org/y", None), (4, "http://a.org/z", ""), (None, "http://b.org/", "<article><p>null id</p></article>"), (5, "no host", "plain")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({n: simhash.F.lit(f"own {n}") for n in ("host", "wrapper", "text", "n_chars")})
    got = sorted((str(r["page_id"]), r["url"], r["text"], r["n_chars"]) for r in html_extract.main_texts(d).collect())
    long = "T\n" + " ".join(["word"] * 40_000)
    want = [("1", "http://a.org/x", long), ("1", "http://a.org/x", long), ("2", None, "no url"), ("3", "http://a.org/y", ""), ("4", "http://a.org/z", ""), ("None", "http://b.org/", "null id"), ("5", "no host", "plain")]
    assert [g[:3] for g in got] == sorted(want, key=lambda w: w[0]) and all(g[3] == len(g[2]) for g in got)
    assert html_extract.main_texts(d.where("false")).collect() == []


def test_near_dedup_of_few_rows(spark):
    for rows, want in (([(1, BASE), (2, "something else")], {1, 2}), ([(2, "x"), (1, "x"), (3, "y"), (4, None)], {1, 3, 4}), ([(1, BASE)], {1})):
        assert {r["doc_id"] for r in simhash.representatives(odd(spark, rows)).collect()} == want
    for radius in (4, 10, 20):  # few fingerprints, partitions narrower than the radius
        d = spark.createDataFrame([(i, f"text {i}") for i in range(4)], "doc_id long, text string")
        assert simhash.near_duplicates(d, radius=radius).count() == 4


def test_rows_that_differ_in_a_null(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    a, b = (1, None, "some words", "s", 0), (1, "some words", None, "s", 0)
    kept = simhash.representatives(spark.createDataFrame([a, b], schema)).collect()
    assert sorted(map(str, kept)) == sorted(str(tuple_row) for tuple_row in spark.createDataFrame([a, b], schema).collect())
    rows = [(7, BASE, "en", "s", 1), (7, BASE, "de", "s", 2), (7, BASE, "de", "s", 2)]
    mixed = C.mixing_stage(spark, spark.createDataFrame(rows, schema), SF).collect()
    each = [sum(1 for r in mixed if r["lang"] == lang) for lang in ("en", "de")]
    assert sum(each) in (4, 5) and each[0] <= 2 and each[1] <= 4  # 150 % of three rows, none over twice


def test_mixing_solves_the_dual(spark):
    """Rates against a direct solve by bisection, and copies against their rates."""
    import math
    import random

    rnd = random.Random(4)
    rows = [(i, " ".join(["w"] * rnd.choice([1, 3, 10, 40, 200])), rnd.choice("abc")) for i in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))[1].collect()
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        total, target = sum(r["size"] for r in own), own[0]["target"]
        scale = total / len(own)
        if target >= 2 * total:
            assert all(r["copies"] == 2 for r in own if r["size"])
            continue
        words = lambda x: sum(r["size"] * 2 / (1 + math.exp(-max(min(x * r["size"] / scale, 700), -700))) for r in own)
        lo, hi = -50.0, 50.0
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if words(mid) < target else (lo, mid)
        for r in own:
            assert r["rate"] == pytest.approx(2 / (1 + math.exp(-lo * r["size"] / scale)), rel=1e-5)
        assert abs(sum(r["copies"] * r["size"] for r in own) - target) <= 2 * min(r["size"] for r in own) + 1
