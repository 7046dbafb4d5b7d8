"""Benchmark decontamination by SimHash of item-sized windows.

Texts are lower-cased (A-Z), ASCII punctuation is left out, and words are compared. Every window of a document that has
as many words as an item gets a weighted SimHash of its 5-word shingles; a multi-index of the items' fingerprints (eight
blocks of a byte, each probed within radius // 8 bits) finds all items within `radius` bits, and the exact weighted
similarity of the two shingle multisets decides. A document of fewer words than an item is one window. At a similarity of 0.8 true
pairs differ in up to 23 of 64 bits, where a block may differ in two: the index passes most items of a window's size,
the whole fingerprints leave about one in a hundred.

A shingle's weight is one over the number of items, of the whole benchmark, that have a shingle of its bucket; hashes are
dealt to BUCKETS buckets, so the table of weights is bounded whatever the benchmark's size.

A window that shares no shingle with any item has similarity 0, so windows are made only where one of their shingles is
some item's; nothing that could reach the threshold is left out by that.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from quillspan.llm import words as W
from quillspan.llm.common import pieces, utf8

#: Windows times items that are compared at once.
CELLS = 1 << 22
#: Buckets of shingles that weigh alike.
BUCKETS = 1 << 20
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def _hashed(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, W.Words]:
    keep = ~_PUNCTUATION[data]
    at = np.concatenate([[0], np.cumsum(keep)])[at]
    data = W.LOWER[data[keep]]
    found = W.find_words(data, at)
    return W.Rolling(data)(found.starts, found.ends), found


class Items:
    """Shingles, weights, fingerprints and the multi-index of a block of benchmark items. weight: of each bucket."""

    def __init__(self, ids: list, texts: list[str | None], weight: np.ndarray, shingle: int, radius: int):
        self.weight = weight
        self.ids, self.shingle, self.radius, self.size, self.bags = ids, shingle, radius, [], []
        for text in texts:
            n, shingles = _shingles(text, shingle)
            self.size.append(n)
            self.bags.append(Counter(shingles.tolist()))
        self.total = [float((self.weights(np.array(list(b), np.uint64)) * np.array(list(b.values()))).sum()) for b in self.bags]
        self.size = np.array(self.size, np.int64)
        self.by_width = {}  # shingles of k words, for items of fewer than `shingle` words too
        self.sizes_of = defaultdict(set)
        for i, bag in enumerate(self.bags):
            for s in bag:
                self.sizes_of[s].add(int(self.size[i]))
        for k in sorted({min(shingle, int(n)) for n in self.size if n}):
            known = np.unique(np.array([s for b, n in zip(self.bags, self.size) if min(shingle, n) == k for s in b], np.uint64))
            seen = np.zeros(1 << 20, bool)
            seen[(known >> np.uint64(44)).astype(np.int64)] = True
            self.by_width[k] = known, seen
        self.prints = np.array([self.fingerprints(np.array(list(b.elements()), np.uint64), len(list(b.elements())))[0] if b else 0 for b in self.bags], np.uint64)
        blocks = self.prints.view(np.uint8).reshape(-1, 8)
        values = np.arange(256, dtype=np.uint8)
        reach = radius // 8
        self.of_size = {int(n): np.flatnonzero(self.size == n) for n in np.unique(self.size)}
        self.near = [{n: np.bitwise_count(values[:, None] ^ blocks[None, own, b]) <= reach for n, own in self.of_size.items()} for b in range(8)]

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        return self.weight[_bucket(shingles)]

    def fingerprints(self, shingles: np.ndarray, n: int) -> np.ndarray:
        """SimHash of each run of n consecutive shingles."""
        signs = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") * 2.0 - 1
        sums = np.concatenate([np.zeros((1, 64)), np.cumsum(signs * self.weights(shingles)[:, None], axis=0)])
        return np.packbits(sums[n:] - sums[:-n] > 1e-9, axis=1, bitorder="little").view(np.uint64).ravel()

    def search(self, shingles: np.ndarray, hits: np.ndarray, k: int, threshold: float) -> Iterator[tuple[int, float, int, int]]:
        """Items that some window of a document is similar to. shingles: all of the document's; hits: places of items' shingles."""
        sizes = sorted({n for s in np.unique(shingles[hits]).tolist() for n in self.sizes_of[s]})
        best: dict[int, tuple[float, int, int]] = {}
        for size in sizes:
            run = min(size - k + 1, len(shingles))  # a shorter document is one window
            reach = np.zeros(len(shingles) + 1, np.int64)
            np.add.at(reach, np.maximum(hits - run + 1, 0), 1)
            np.add.at(reach, hits + 1, -1)
            starts = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
            starts = starts[starts + run <= len(shingles)]
            if not len(starts):
                continue
            cut = np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1)
            prints = np.concatenate([self.fingerprints(shingles[c[0] : c[-1] + run], run) for c in cut])
            same = self.of_size[size]
            for lo in range(0, len(starts), max(1, CELLS // len(same))):
                found = np.zeros((len(starts[lo : lo + max(1, CELLS // len(same))]), len(same)), bool)
                for b, column in enumerate(prints[lo : lo + len(found)].view(np.uint8).reshape(-1, 8).T):
                    found |= self.near[b][size][column]
                for w, j in zip(*np.nonzero(found)):
                    w, i = lo + w, int(same[j])
                    apart = int(np.bitwise_count(prints[w] ^ self.prints[i]))
                    if apart > self.radius:
                        continue
                    score = self.similarity(shingles[starts[w] : starts[w] + run], i)
                    if score >= threshold and score > best.get(i, (0,))[0]:
                        best[i] = score, apart, int(starts[w])
        for i, (score, apart, start) in best.items():
            yield i, score, apart, start

    def similarity(self, shingles: np.ndarray, i: int) -> float:
        """Twice the shared weight over the sum of both weights."""
        bag, item = Counter(shingles.tolist()), self.bags[i]
        keys = np.array(list(bag), np.uint64)
        weight, n = self.weights(keys), np.array(list(bag.values()))
        both = (weight * np.minimum(n, [item[s] for s in bag])).sum()
        return float(2 * both / ((weight * n).sum() + self.total[i]))


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(BUCKETS - 1)).astype(np.int64)


def _shingles(text: str | None, shingle: int) -> tuple[int, np.ndarray]:
    """Number of words of a text, and its shingles; a shorter text is one."""
    h, found = _hashed(*utf8(pa.array([text], pa.string())))
    k = min(shingle, len(h))
    return len(h), W.grams(h, found.doc, k)[0] if k else np.zeros(0, np.uint64)


def weights(benchmark: DataFrame, shingle: int, text_col: str) -> np.ndarray:
    """Of each bucket, one over the number of items that have a shingle in it, at least one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for rb in batches:
            for text in rb.column(0).to_pylist():
                n[np.unique(_bucket(_shingles(text, shingle)[1]))] += 1
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], names=["bucket", "n"])

    rows = benchmark.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    out = np.ones(BUCKETS)
    out[rows.column("bucket").to_numpy()] = 1 / rows.column("n").to_numpy()
    return out


SCHEMA = "similarity double, bits int, first_word long, n_words long"


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, shingle: int = 5, radius: int = 23,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block: int = 20_000,
) -> DataFrame:
    """Documents that hold a window similar to a benchmark item: one row for each such document and item, of its best window.

    Returns doc_id, item_id, similarity, bits (that the fingerprints differ in), first_word and n_words (the item's).
    The items are read in blocks of `block` rows; each block is sent to the executors and searched over all documents, so
    the items in memory are bounded whatever the benchmark's size; results don't depend on the blocks. Items without a word, null texts and texts without a
    word match nothing; items shorter than a shingle are one shingle. Rows with a null id keep it; repeated documents or
    items give repeated rows; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    kind = lambda df: df.schema[0].dataType.simpleString()
    schema = f"doc_id {kind(texts)}, item_id {kind(items)}, {SCHEMA}"
    weight = spark.sparkContext.broadcast(weights(items, shingle, "text"))
    lines = items.toLocalIterator()
    out = spark.createDataFrame([], schema)
    while chunk := list(islice(lines, block)):
        out = out.union(_search(texts, chunk, weight, threshold, shingle, radius, schema))
    return out


def _search(docs: DataFrame, chunk: list, weight, threshold: float, shingle: int, radius: int, schema: str) -> DataFrame:
    items = docs.sparkSession.sparkContext.broadcast(([r["item_id"] for r in chunk], [r["text"] for r in chunk]))
    kinds = [f.type for f in to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(*items.value, weight.value, shingle, radius)
        for rb in batches:
            ids = rb.column(0)
            data, at = utf8(rb.column(1))
            rows = []
            for lo, hi in pieces(at):
                h, found = _hashed(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                for k, (shingles, seen) in known.by_width.items():
                    g, where = W.grams(h, found.doc, k)
                    maybe = np.flatnonzero(seen[(g >> np.uint64(44)).astype(np.int64)])
                    place = np.minimum(np.searchsorted(shingles, g[maybe]), len(shingles) - 1)
                    maybe = maybe[shingles[place] == g[maybe]]
                    if not len(maybe):
                        continue
                    doc = found.doc[where]
                    for d in np.unique(doc[maybe]):
                        s, e = np.searchsorted(doc, [d, d + 1])
                        for i, score, apart, start in known.search(g[s:e], maybe[(maybe >= s) & (maybe < e)] - s, k, threshold):
                            rows.append((ids[lo + int(d)].as_py(), known.ids[i], score, apart, start, int(known.size[i])))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "item_id", "similarity", "bits", "first_word", "n_words"])

    return docs.mapInArrow(run, schema)
