import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from quillspan.llm import token_counts, token_files

SF = "/root/testdata/sf0.001"
WORDS, BYTES = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "a", "A<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", "don't I'LL 'S  x\n\n\ny\t z  ", "é́x ÅB ÀÉ İΣΑΣ nb sp\x85x", "日本語 тест 🙂👍🏽 x<|endof", "a " * 5000,
    "x" * 3000, "\n \n  <|endoftext|>  ", "1234567 89,0.1", "\x1c\x1d q \x0b\x0c w",
]


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 5000])
def test_pack_round_trip(n):
    rnd = np.random.default_rng(n)
    values = rnd.integers(0, 50000, n).astype(np.uint32)
    values[rnd.random(n) < 0.02] = 2**32 - 1
    if n > 2000:
        values[1024:2048] = 7
    counts = np.array([n // 3, 0, n - n // 3])
    s = token_files.Segment(token_files.pack(values, np.array([5, -1, 9]), np.array([True, False, True]), counts))
    assert (s.blocks(0, len(s.starts)) == values).all() and s.counts.tolist() == counts.tolist() and s.doc_ids.tolist() == [5, -1, 9]
    if n:
        assert (s.values(n // 2, n) == values[n // 2 :]).all()


def test_files_match_library(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(None, "null id")] + [(90000 + i, t) for i, t in enumerate(ODD)]
    random.Random(1).shuffle(rows)
    tok, want, start = Tokenizer.from_file(WORDS), [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in token_files.token_files(docs, WORDS, segment_tokens=20000).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert token_files.token_files(docs.limit(0), WORDS).collect() == []


def test_counts_match_library(spark):
    tok = Tokenizer.from_file(BYTES)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(None, "null id")] + [(90000 + i, t) for i, t in enumerate(ODD)]
    got = token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), BYTES).collect()
    want = [(d, len((t or "").encode()), n := len(tok.encode(t or "", add_special_tokens=False).ids), n > 1024) for d, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_prefixes_match_library(spark):
    tok = Tokenizer.from_file(BYTES)
    texts = [t for t in ODD if t and len(t) < 200] + [r[0][:300] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(4).collect()]
    table = token_counts.counter(BYTES)
    for t in texts:
        want = [len(tok.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert table.prefixes(t).tolist() == want, t
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    from pyspark.sql import functions as F

    for budget in (0, 3, 20):
        got = df.select("text", token_counts.truncated(F.col("text"), token_counts.prefix_column(F.col("text"), BYTES), budget).alias("t")).collect()
        assert all(r["t"] == r["text"][: table.within(r["text"], budget)] for r in got)
