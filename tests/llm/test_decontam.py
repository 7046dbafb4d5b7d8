from collections import Counter

import numpy as np
import pyarrow as pa

from quillspan.llm import decontam, words

SF = "/root/testdata/sf0.001"


def norm(text):
    t = "".join(c for c in (text or "") if not (c.isascii() and c.isprintable() and not c.isalnum() and c != " "))
    return t.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()


def grams(w, k=5):
    k = min(k, len(w))
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if k else []


def shingle(gram, known={}):
    """The hash of a shingle, by way of a text that is nothing else."""
    if gram not in known:
        known[gram] = int(decontam._shingles(b" ".join(gram).decode(), 5)[1][0])
    return known[gram]


def brute(docs, items, threshold):
    place = lambda g: int(decontam._bucket(np.array([shingle(g)], np.uint64))[0])
    df = Counter(b for _, t in items for b in {place(g) for g in grams(norm(t))})
    wt = lambda g: 1 / max(df[place(g)], 1)
    out = {}
    for d, t in docs:
        w = norm(t)
        for i, x in items:
            v = norm(x)
            n, k = len(v), min(5, len(v))
            if not n:
                continue
            b = Counter(grams(v))
            g = [tuple(w[p : p + k]) for p in range(len(w) - k + 1)]
            if not set(g) & set(b):
                continue
            best = 0
            for p in range(max(1, len(w) - n + 1)):
                a = Counter(g[p : p + n - k + 1])
                both = sum(min(c, b[s]) * wt(s) for s, c in a.items() if s in b)
                best = max(best, 2 * both / (sum(c * wt(s) for s, c in a.items()) + sum(c * wt(s) for s, c in b.items())))
            if best >= threshold:
                out[d, i] = round(best, 9)
    return out


def test_windows_match_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    w = items[3][1].split()
    edited = [*w[:20], "zzz", *w[21:]]
    docs += [(9001, f"{docs[0][1]} {items[0][1].upper()} {docs[1][1]}"), (9002, "a b " + " ".join(edited)), (9003, " ".join(w[:12])), (9004, None), (9005, ""), (9006, "tiny item"), (9006, "tiny item"), (9007, " ".join(w[:-2])), (9008, " ".join(w[3:])), (None, "of a null id " + items[5][1]), (9009, "x y " * 30000 + items[7][1])]
    items += [(900, "Tiny, item"), (901, None), (902, " "), (903, items[0][1])]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block=17).collect()
    whole = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items, 0.8)
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in whole} == want
    assert sorted(map(str, got)) == sorted(map(str, whole))
    assert len(whole) == len(want) + 1  # 9006 is there twice
    assert {(9001, 0), (9001, 903), (9006, 900), (9007, 3), (9008, 3), (None, 5), (9009, 7)} <= set(want)
    odd = spark.createDataFrame([(str(d), t, "y", 1) for d, t in docs], "id string, body string, text string, bits int")
    named = decontam.contaminated(odd, spark.createDataFrame([(t, "n", i) for i, t in items], "body string, text string, no long"), id_col="id", text_col="body", item_col="no", item_text_col="body").collect()
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in named} == {(str(d), i): v for (d, i), v in want.items()}
    assert decontam.contaminated(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect() == []
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), empty).collect() == []


def test_words_and_hashes():
    texts = ["a b\x0bc  é\x85x ", "", "b", " \n", "abc abc a"]
    raw = "".join(texts).encode()
    at = np.cumsum([0, *[len(t.encode()) for t in texts]])
    data = np.frombuffer(raw, np.uint8)
    got = words.find_words(data, at)
    spans = [[raw[s:e] for s, e, d in zip(got.starts, got.ends, got.doc) if d == i] for i in range(len(texts))]
    assert spans == [t.encode().split() for t in texts]
    h = words.Rolling(data)(got.starts, got.ends)
    keys = [w for s in spans for w in s]
    assert all((h[i] == h[j]) == (keys[i] == keys[j]) for i in range(len(keys)) for j in range(len(keys)))
