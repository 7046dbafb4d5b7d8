"""Ranked lexical search over dual-sorted wavelet trees.

A shard holds the posting lists of some thousand documents, each list ordered by descending impact. A wavelet tree over
the lists, one after the other, splits their entries by document number and keeps that order in every node: so a list's
part in a node is a run that ranks find, and its first entry is the largest impact that the subtree's documents can get from the
term. Nodes are opened best first by the sum of these bounds; a subtree whose bound is below the k-th best score so far is never
opened, and the documents of a leaf are scored exactly. The k-th best score goes on from shard to shard of a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillspan.llm.common import discard, materialise, pieces, rows_a_batch, utf8
from quillspan.llm.terms import counted, hashed

#: Documents and entries of a shard at most (a single document may have more), documents of a leaf (a power of two), nodes opened at once.
SHARD, ENTRIES, LEAF, OPENED = 4096, 2_000_000, 32, 16
#: Hashes of terms that are sent to tasks at most, as a vocabulary or as a block of items.
MOST_TERMS = 2_000_000


def _index(docs: DataFrame, terms: np.ndarray | None, shard: int) -> DataFrame:
    """A row a shard: ids and n of its documents; terms, the length of each one's list, and the lists' documents and tf.

    terms: only these (sorted hashes) have lists; n counts all terms of a text.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed() -> pa.RecordBatch:
            doc, h, tf = (np.concatenate(x) for x in zip(*held, strict=True))
            sort = np.lexsort((doc, h))
            doc, h, tf = doc[sort], h[sort], tf[sort]
            head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
            one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, t))
            return pa.RecordBatch.from_arrays([
                one(pa.concat_arrays(ids), None), one(np.concatenate(sizes), pa.int64()), one(h[head].view(np.int64), pa.int64()),
                one(np.diff(np.r_[head, len(h)]), pa.int64()), one(doc, pa.int32()), one(tf, pa.int32()),
            ], names=["ids", "n", "terms", "dfs", "docs", "tfs"])

        ids, sizes, held, n, entries = [], [], [], 0, 0
        for rb in batches:
            data, at = utf8(rb.column(1))
            for lo, hi in pieces(at):
                a = lo
                words, hashes = hashed(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
                while a < hi:
                    b = min(hi, a + shard - n)
                    u, v = words.first[a - lo], words.first[b - lo]
                    doc, h = words.doc[u:v] - (a - lo) + n, hashes[u:v]
                    if terms is not None and len(h):
                        place = np.minimum(np.searchsorted(terms, h), max(len(terms) - 1, 0))
                        own = terms[place] == h if len(terms) else np.zeros(len(h), bool)
                        doc, h = doc[own], h[own]
                    held.append(counted(doc, h))
                    ids.append(rb.column(0).slice(a, b - a))
                    sizes.append(np.diff(words.first[a - lo : b - lo + 1]))
                    n, entries, a = n + b - a, entries + len(held[-1][0]), b
                    if n >= shard or entries >= ENTRIES:
                        yield closed()
                        ids, sizes, held, n, entries = [], [], [], 0, 0
        if n:
            yield closed()

    return docs.mapInArrow(build, f"ids array<{kind}>, n array<long>, terms array<long>, dfs array<long>, docs array<int>, tfs array<int>")


@dataclass
class DualSorted:
    """Level 0 holds the lists one after the other by descending impact; level l is it sorted by the first l bits of the document
    number, stably. zeros[l, i]: entries before i at level l that go to the left."""

    terms: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    zeros: np.ndarray
    impact: np.ndarray
    docs: np.ndarray  # of the last level
    depth: int
    leaf: int

    @classmethod
    def of(cls, terms: np.ndarray, ends: np.ndarray, docs: np.ndarray, impacts: np.ndarray, count: int, leaf: int = LEAF) -> DualSorted:
        begin = np.r_[0, ends[:-1]].astype(np.int64) if len(ends) else ends
        lists = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
        order = np.lexsort((docs, -impacts, lists))
        depth = max(0, (-(-count // leaf) - 1).bit_length())
        docs, impacts = docs[order], impacts[order]
        zeros, impact = np.zeros((depth, len(docs) + 1), np.int32), np.zeros((depth + 1, len(docs)), np.int64)
        impact[0] = impacts
        last = docs
        for level in range(depth):
            left = (last // leaf >> (depth - 1 - level)) & 1 == 0
            np.cumsum(left, out=zeros[level, 1:])
            sort = np.argsort(docs // leaf >> (depth - 1 - level), kind="stable")
            last, impact[level + 1] = docs[sort], impacts[sort]
        return cls(terms, begin, ends, zeros, impact, last, depth, leaf)

    def search(self, asked: np.ndarray, weights: np.ndarray, k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, leaves scored): all documents that are among the k best, and of which none has a score of 0 or below
        floor; ties with the k-th are kept, so there may be more."""
        none = np.zeros(0, np.int64)
        place = np.searchsorted(self.terms, asked)
        met = (place < len(self.terms)) & (self.terms[np.minimum(place, max(len(self.terms) - 1, 0))] == asked) if len(self.terms) else np.zeros(len(asked), bool)
        w, place = weights[met].astype(np.int64), place[met]
        if not len(place):
            return none, none, 0
        floor, opened = max(1, floor), 0
        level, start, stop = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, len(self.docs))
        a, b = self.begin[place][None], self.end[place].astype(np.int64)[None]
        got_d, got_s = none, none
        bound = self._bounds(level, a, b, w)
        while True:
            live = bound >= floor
            if not live.all():
                level, start, stop, a, b, bound = level[live], start[live], stop[live], a[live], b[live], bound[live]
            if not len(bound):
                return got_d, got_s, opened
            best = np.argpartition(-bound, OPENED)[:OPENED] if len(bound) > OPENED else np.arange(len(bound))
            rest = np.ones(len(bound), bool)
            rest[best] = False
            done, deep = best[level[best] == self.depth], best[level[best] < self.depth]
            if len(done):
                opened += len(done)
                d, s = self._scores(a[done], b[done], w)
                got_d, got_s = np.concatenate([got_d, d]), np.concatenate([got_s, s])
                if len(got_s) >= k:
                    floor = max(floor, int(np.partition(got_s, -k)[-k]))
                own = got_s >= floor
                got_d, got_s = got_d[own], got_s[own]
            parts = [tuple(x[rest] for x in (level, start, stop, a, b, bound))]
            if len(deep):
                lv, s, e, x, y = level[deep], start[deep], stop[deep], a[deep], b[deep]
                z, each = self.zeros[lv, s], lv[:, None]
                mid = s + self.zeros[lv, e] - z
                zx, zy = self.zeros[each, x] - z[:, None], self.zeros[each, y] - z[:, None]
                for side in ((s, mid, s[:, None] + zx, s[:, None] + zy), (mid, e, mid[:, None] + (x - s[:, None]) - zx, mid[:, None] + (y - s[:, None]) - zy)):
                    parts.append((lv + 1, *side, self._bounds(lv + 1, side[2], side[3], w)))
            level, start, stop, a, b, bound = (np.concatenate(x) for x in zip(*parts, strict=True))

    def _bounds(self, level: np.ndarray, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        first = self.impact[level[:, None], np.minimum(a, len(self.docs) - 1)]
        return (np.where(b > a, first, 0) * w).sum(axis=1)

    def _scores(self, a: np.ndarray, b: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = (b - a).ravel()
        at = np.repeat(a.ravel() - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        score = self.impact[self.depth, at] * np.repeat(np.tile(w, len(a)), n)
        docs, inverse = np.unique(self.docs[at], return_inverse=True)
        total = np.zeros(len(docs), np.int64)
        np.add.at(total, inverse, score)
        return docs, total


def impacts(tf: np.ndarray, doc: np.ndarray, n: np.ndarray, rows: int, length: int) -> np.ndarray:
    m = np.array([75 + 25 * v * rows // max(length, 1) for v in n.tolist()], np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])


def weight(rows: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * rows + 2) / (2 * df + 1)))


def _asked(items: DataFrame) -> DataFrame:
    """k1, k2 of each different text with its terms (array<struct<term, times>>)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            data, at = utf8(rb.column(2))
            words, h = hashed(data, at)
            doc, h, times = counted(words.doc, h)
            ends = pa.array(np.searchsorted(doc, np.arange(rb.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (h.view(np.int64), times)]
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), *lists], names=["k1", "k2", "terms", "times"])

    texts = items.where("text is not null").select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    return texts.mapInArrow(find, "k1 long, k2 long, terms array<long>, times array<long>").where(F.size("terms") > 0)


def _best(index: DataFrame, asked: list, df: dict[int, int], rows: int, length: int, k: int, kind: str) -> DataFrame:
    """place (of the item in asked), doc and score of the k best documents of each task, and those that tie with the last."""
    terms = [np.array(r["terms"], np.int64).view(np.uint64) for r in asked]
    weights = [np.array([weight(rows, df.get(t, 0)) * c for t, c in zip(r["terms"], r["times"], strict=True)], np.int64) for r in asked]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in terms]
        for rb in batches:
            for i in range(rb.num_rows):
                of = lambda name: rb.column(rb.schema.get_field_index(name))[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
                docs, n = of("docs").astype(np.int64), of("n")
                tree = DualSorted.of(of("terms").view(np.uint64), np.cumsum(of("dfs")), docs, impacts(of("tfs").astype(np.int64), docs, n, rows, length), len(n))
                ids = rb.column(rb.schema.get_field_index("ids"))[i].values
                for j, (t, w) in enumerate(zip(terms, weights, strict=True)):
                    d, s, _ = tree.search(t, w, k, best[j][-1][0] * -1 if len(best[j]) == k else 0)
                    if len(d):
                        found = [(-int(x), y is None, y) for x, y in zip(s, ids.take(pa.array(d)).to_pylist(), strict=True)]
                        best[j] = sorted([*best[j], *found], key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]
        rows_out = [(j, x[2], -x[0]) for j, found in enumerate(best) for x in found]
        schema = [pa.array([r[0] for r in rows_out], pa.int32()), pa.array([r[1] for r in rows_out], id_type), pa.array([r[2] for r in rows_out], pa.int64())]
        yield pa.RecordBatch.from_arrays(schema, names=["place", "doc", "score"])

    id_type = to_arrow_type(index.schema["ids"].dataType.elementType)
    return index.mapInArrow(search, f"place int, doc {kind}, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", item_col: str = "item_id", shard: int = SHARD, most_terms: int = MOST_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents with a score above 0.

    Terms are those of llm.terms, scores as in weight() and impacts(): a term's weight times its impact in the document, summed over
    the item's terms with repeats; equal scores go by ascending id, a null id last, and each row of docs counts as a
    document. Null and empty texts have no terms: such documents are in no list, such items in no result. Every row of items
    has its own result; equal texts are searched once. Only ids and texts are read, so other columns may have any name.
    Terms are told apart by 64-bit hashes.

    Lists are kept for the terms that items ask for, or for all terms if these are more than most_terms; items go to the tasks
    in blocks of at most about most_terms terms, over the same index.
    """
    spark = docs.sparkSession
    keyed = items.select(F.col(item_col).alias("item"), F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"), "text")
    asked = materialise(_asked(keyed), "asked")
    words = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    few = None
    if words <= most_terms:  # else lists of all terms
        few = np.unique(np.array([r[0] for r in asked.select(F.explode("terms")).distinct().collect()], np.int64).view(np.uint64))
    text = docs.select(F.col(id_col).alias("id"), "text")
    kind = text.schema["id"].dataType.simpleString()
    with rows_a_batch(spark, 1000):
        index = materialise(_index(text, few, shard), "index")
    each = F.explode("n").alias("v")
    rows, length = index.select(each).where("v > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("v"), F.lit(0))).first()
    each = F.explode(F.arrays_zip("terms", "dfs")).alias("l")
    df = materialise(index.select(each).groupBy(F.col("l.terms").alias("term")).agg(F.sum("l.dfs").alias("df")), "df")
    blocks = max(1, -(-words // most_terms))
    found = []
    with rows_a_batch(spark, 2):
        for b in range(blocks):
            own = asked.where(F.pmod("k2", F.lit(blocks)) == b)
            block = own.orderBy("k1", "k2").collect()  # about most_terms terms
            if not block or not rows:
                continue
            wanted = own.select(F.explode("terms").alias("term")).distinct()
            known = {r["term"]: r["df"] for r in df.join(wanted, "term").collect()}
            best = _best(index, block, known, rows, length, k, kind)
            first = Window.partitionBy("place").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
            top = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            names = spark.createDataFrame([(i, r["k1"], r["k2"]) for i, r in enumerate(block)], "place int, k1 long, k2 long")
            found.append(materialise(top.join(names, "place").select("k1", "k2", "rank", F.col("doc").alias(id_col), "score"), "found"))
    discard(index)
    discard(df)
    named = keyed.select(F.col("item").alias(item_col), "k1", "k2")
    out = ["rank", id_col, "score"]
    if not found:
        return named.where("false").select(item_col, F.lit(0).alias("rank"), F.lit(None).cast(kind).alias(id_col), F.lit(0).cast("long").alias("score"))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return named.join(best, ["k1", "k2"]).select(item_col, *out)
