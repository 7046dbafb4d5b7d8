"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts of up to ORDER bytes, trained on all training documents: counts of ORDER + 1 bytes
are summed over the corpus, those of shorter contexts follow as sums over suffixes. A symbol that its context has seen n
times, of N with q different ones, has chance n / (N + q); else q / (N + q) is the chance to escape to the next shorter context, where the symbols
of the longer one are excluded; after the last come the symbols never seen, all alike. A text's score is the base-10
logarithm of the chance of its bytes (A-Z lower-cased) and an end symbol, from a start context.

The model is whole: no sequence is left out, however rare. A symbol's chance depends on its ORDER bytes of context alone, so
each sequence of ORDER + 1 bytes is scored once. The most frequent ones, a bounded number, are sent to the executors; a
document's others are joined with their scores. Sequences that no training document has are scored by joins with the
tables of all context lengths. The unigram base score's words are treated alike: the rarer ones are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspan.llm import words as W
from quillspan.llm.common import materialise, pieces, rows_a_batch, utf8

ORDER = 5
#: Bytes that UTF-8 never has: before and after a text.
START, END = 0xFE, 0xFF
SYMBOLS = 257


class Table:
    """A hash table from 64-bit keys to their place in `keys`; lookups are done for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.asarray(keys, np.uint64)
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1)))) + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys), dtype=np.int32), self._home(self.keys)
        while len(left):
            free = self.slots[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            self.slots[slot] = left[free][first]
            stay = self.slots[at] != left
            left, at = left[stay], (at[stay] + 1) & self.mask
        self.slot_keys = np.where(self.slots >= 0, self.keys[np.maximum(self.slots, 0)] if len(keys) else 0, 0).astype(np.uint64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys, -1 for those that aren't here."""
        at = self._home(keys)
        out = self.slots[at]
        wrong = np.flatnonzero((out >= 0) & (self.slot_keys[at] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & self.mask
            out[wrong] = self.slots[at[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.slot_keys[at[wrong]] != keys[wrong])]
        return out


def byte_keys(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and symbol of every byte and of the end of each row, and the row offsets into them."""
    n = len(at) - 1
    gap = ORDER + 1  # ORDER start bytes before a row and an end byte after it
    long = np.full(len(data) + gap * n, START, np.uint8)
    place = at[:-1] + gap * np.arange(n) + ORDER
    long[np.arange(len(data)) + np.repeat(gap * np.arange(n) + ORDER, np.diff(at))] = data
    ends = place + np.diff(at)
    long[ends] = END
    key = np.zeros(len(long) - ORDER if n else 0, np.uint64)
    for i in range(ORDER + 1):
        key = (key << np.uint64(8)) | long[i : len(key) + i]
    real = np.ones(len(key), bool)
    for i in range(ORDER):  # keys whose symbol is a start byte
        drop = place[1:] - ORDER - 1 - i
        real[drop[(drop >= 0) & (drop < len(key))]] = False
    return key[real], at + np.arange(n + 1)


def _add(held: list, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
    if counts is None:
        keys, counts = np.unique(keys, return_counts=True)
    held.append((keys, counts))
    if len(held) > 1 and sum(len(k) for k, _ in held[1:]) > max(len(held[0][0]), 200_000):
        held[:] = [_merged(held)]


def _merged(held: list) -> tuple[np.ndarray, np.ndarray]:
    if not held:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)


WORD, GRAM, ENDS = 0, 1, 2


def _count(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    words, grams, docs = [], [], 0

    def out(kind: int, held: list) -> Iterator[pa.RecordBatch]:
        keys, n = _merged(held)
        held.clear()
        for lo in range(0, len(keys), 100_000):
            k = keys[lo : lo + 100_000].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n[lo : lo + 100_000])], names=["kind", "key", "n"])

    for rb in batches:
        data, at = utf8(rb.column(0))
        docs += len(at) - 1
        for lo, hi in pieces(at):
            lower, own = W.LOWER[data[at[lo] : at[hi]]], at[lo : hi + 1] - at[lo]
            found = W.find_words(lower, own)
            _add(words, W.Rolling(lower)(found.starts, found.ends))
            _add(grams, byte_keys(lower, own)[0])
            for kind, held in ((WORD, words), (GRAM, grams)):
                if sum(len(k) for k, _ in held) > most:
                    yield from out(kind, held)
    yield from out(WORD, words)
    yield from out(GRAM, grams)
    yield from out(ENDS, [(np.zeros(1, np.uint64), np.array([docs]))])


def held_out_column(id_col: str = "doc_id"):
    """Whether crc32 of the id as text is divisible by 10; a null id counts as the empty text (crc32 0) and is held out."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _suffixes(first: int = 0):
    """Array of context lengths k with the masks of k bytes and a symbol, and of k bytes."""
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit((1 << 8 * (k + 1)) - 1).alias("mask"), F.lit((1 << 8 * k) - 1).alias("of")) for k in range(first, ORDER + 1)])


def unseen_scores(keys: DataFrame, grams: DataFrame) -> DataFrame:
    """key and score of keys (distinct) that grams (key, n), the training counts of ORDER + 1 bytes, has not.

    Contexts of up to 2 bytes are at most 257 * 257, as are sequences of up to 2 bytes: these are broadcast, because many
    keys share one. Longer ones are joined.
    """
    levels = (
        grams.select("n", "key", F.explode(_suffixes()).alias("s"))
        .groupBy(F.col("s.k").alias("k"), F.col("key").bitwiseAND(F.col("s.mask")).alias("gram")).agg(F.sum("n").alias("n"))
    )
    levels = materialise(levels, "levels")
    met = materialise(keys.select("key", F.explode(_suffixes()).alias("s")).select("key", F.col("s.k").alias("k"), F.col("key").bitwiseAND(F.col("s.mask")).alias("gram"), F.shiftright("key", 8).bitwiseAND(F.col("s.of")).alias("context")), "met")
    own = levels.withColumn("context", F.shiftright("gram", 8)).join(met.select("k", "context").distinct(), ["k", "context"])
    # Of each symbol of a context, the count in the context shorter by a byte: what exclusion takes from that one.
    own = own.withColumns({"shorter": F.col("k") - 1, "suffix": F.col("gram").bitwiseAND(F.element_at(F.array(*[F.lit((1 << 8 * max(k, 1)) - 1) for k in range(ORDER + 1)]), F.col("k") + 1))})
    up = levels.select(F.col("k").alias("shorter"), F.col("gram").alias("suffix"), F.col("n").alias("above"))
    contexts = own.join(up, ["shorter", "suffix"], "left").groupBy("k", "context").agg(F.sum("n").alias("seen"), F.count(F.lit(1)).alias("kinds"), F.sum("above").alias("taken"))
    contexts = materialise(contexts, "contexts")

    def join(rows: DataFrame, table: DataFrame, on: list[str], low: int) -> DataFrame:
        few = rows.where(F.col("k") <= low).join(F.broadcast(table.where(F.col("k") <= low)), on, "left")
        return few.unionByName(rows.where(F.col("k") > low).join(table.where(F.col("k") > low), on, "left"))

    found = join(join(met, levels, ["k", "gram"], 1), contexts, ["k", "context"], 2)
    at = lambda name, k: F.max(F.when(F.col("k") == k, F.col(name))).alias(f"{name}{k}")
    wide = found.groupBy("key").agg(*[at(x, k) for x in ("n", "seen", "kinds", "taken") for k in range(ORDER + 1)])
    # One summand for each context length: the chance of the symbol at the longest that knows it, of escape at longer ones.
    parts = [F.when(F.col("n0").isNull(), -F.log10(F.greatest(F.lit(SYMBOLS) - F.coalesce("kinds0", F.lit(0)), F.lit(1)).cast("double"))).otherwise(0.0)]
    for k in range(ORDER + 1):
        whole, leave, over = F.col(f"seen{k}") + F.col(f"kinds{k}"), F.col(f"kinds{k}"), F.col(f"seen{k}").isNull()
        if k < ORDER:  # without the symbols of the longer context, if that one is known
            whole = whole - F.coalesce(F.col(f"taken{k + 1}") + F.col(f"kinds{k + 1}"), F.lit(0))
            leave = leave - F.coalesce(f"kinds{k + 1}", F.lit(0))
            over = over | F.col(f"n{k + 1}").isNotNull()
        met = F.coalesce(f"n{k}", leave)
        parts.append(F.when(over | (met <= 0), 0.0).otherwise(F.log10(met.cast("double")) - F.log10(whole.cast("double"))))
    out = reduce(Column.__add__, parts)
    return wide.select("key", out.alias("score"))


def _least_count(table: DataFrame, most: int) -> int:
    """A count that at most `most` rows of the table reach: those are broadcast, the others are joined.

    This decides where a value is looked up and not what it is. Counts are summed over sixteenths of powers of two, so
    about a thousand numbers reach the driver however many counts there are.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    held = table.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("least")).collect()
    total, chosen = 0, None
    for row in sorted(held, reverse=True):
        total += row["rows"]
        if total > most:
            break
        chosen = row["least"]
    if chosen is None:
        return max((r["least"] for r in held), default=0) * 2 + 1
    return chosen


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 500_000) -> DataFrame:
    """Unigram base score and PPM score of every document.

    most: how many of the most frequent sequences, and of the most frequent words, are broadcast; it changes no result.
    Returns doc_id, held_out, n_tokens (words and an end), n_known, train_tokens, base_score and score. Null texts are
    empty: an end and nothing else. Repeated rows are counted and scored each; with no training documents every count is
    0 and all symbols are alike; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out_column(id_col).alias("held_out"))
    counts = own.where(~F.col("held_out")).select("text").mapInArrow(_count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    with rows_a_batch(spark, 2000):
        counts = materialise(counts, "counts")
    totals = {r["kind"]: (r["n"], r["v"]) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    ends = totals.get(ENDS, (0, 0))[0]
    n_words, n_kinds = totals.get(WORD, (0, 0))
    n, v = n_words + ends, n_kinds + (ends > 0)
    context = Window.partitionBy(F.shiftright("key", 8))  # at most 257 rows each
    seen = F.sum("n").over(context) + F.count(F.lit(1)).over(context)
    grams = materialise(counts.where(F.col("kind") == GRAM).select("key", "n", (F.log10(F.col("n").cast("double")) - F.log10(seen.cast("double"))).alias("s")), "grams")
    frequent_from = _least_count(grams, most)
    top = grams.where(F.col("n") >= frequent_from).select("key", "s").toArrow()  # at most `most` rows
    top = top.column("key").to_numpy().view(np.uint64), top.column("s").to_numpy()
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    word_from = _least_count(words, most)
    rare = words.where(F.col("n") < word_from).withColumnRenamed("n", "c")
    words = words.where(F.col("n") >= word_from).toArrow()  # at most `most` rows
    frequent = words.column("key").to_numpy().view(np.uint64), words.column("n").to_numpy()
    model = spark.sparkContext.broadcast((top, frequent, ends))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (top, chance), (known, n_known), ends = model.value
        grams, table, uid = Table(top), Table(known), TaskContext.get().partitionId() << 40
        value = np.log10(n_known + 0.1)
        for rb in batches:
            data, at = utf8(rb.column(1))
            for lo, hi in pieces(at):
                lower, own = W.LOWER[data[at[lo] : at[hi]]], at[lo : hi + 1] - at[lo]
                keys, place = byte_keys(lower, own)
                g = grams.find(keys)
                hit, miss = np.flatnonzero(g >= 0), np.flatnonzero(g < 0)
                symbol = np.zeros(len(keys))
                symbol[hit] = chance[g[hit]]
                score = np.diff(np.concatenate([[0.0], np.cumsum(symbol)])[place])
                miss, doc = keys[miss], np.searchsorted(place[1:], miss, "right")
                order = np.lexsort((miss, doc))
                miss, doc = miss[order], doc[order]
                new = np.flatnonzero(np.concatenate([[True], (miss[1:] != miss[:-1]) | (doc[1:] != doc[:-1])])) if len(miss) else miss[:0].astype(np.int64)
                times = np.diff(np.append(new, len(miss)))
                far = pa.array(np.searchsorted(doc[new], np.arange(hi - lo + 1)).astype(np.int32))
                found = W.find_words(lower, own)
                h = W.Rolling(lower)(found.starts, found.ends)
                w = table.find(h)
                hot = w >= 0
                base = np.bincount(found.doc[hot], value[w[hot]], hi - lo) + np.log10(ends + 0.1)
                cold = np.concatenate([[0], np.cumsum(~hot)])[found.first].astype(np.int32)
                cols = [
                    pa.array(np.arange(uid, uid + hi - lo)), rb.column(0).slice(lo, hi - lo), rb.column(2).slice(lo, hi - lo), pa.array(np.diff(found.first) + 1),
                    pa.array(np.bincount(found.doc[hot], minlength=hi - lo) + (ends > 0)), pa.array(base), pa.array(score),
                    pa.ListArray.from_arrays(pa.array(cold), pa.array(h[~hot].view(np.int64))),
                    pa.ListArray.from_arrays(far, pa.array(miss[new].view(np.int64))), pa.ListArray.from_arrays(far, pa.array(times)),
                ]
                uid += hi - lo
                yield pa.RecordBatch.from_arrays(cols, names=["uid", "doc_id", "held_out", "n_tokens", "hot", "base", "score", "cold", "miss", "times"])

    first = own.select("doc_id", "text", "held_out").mapInArrow(run, "uid long, doc_id long, held_out boolean, n_tokens long, hot long, base double, score double, cold array<long>, miss array<long>, times array<long>")
    with rows_a_batch(spark, 2000):
        first = materialise(first, "scored")
    met = first.select("uid", F.explode("cold").alias("key")).join(rare, "key", "left")
    sums = met.groupBy("uid").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).alias("more"), F.count("c").alias("rare"))
    missed = first.select("uid", "held_out", F.inline(F.arrays_zip(F.col("miss").alias("key"), F.col("times").alias("times"))))
    unseen = materialise(missed.where("held_out").select("key").distinct().join(grams, "key", "left_anti"), "unseen")
    rare_grams = grams.where(F.col("n") < frequent_from).select("key", "s").union(unseen_scores(unseen, grams))
    rest = missed.join(rare_grams, "key").groupBy("uid").agg(F.sum(F.col("times") * F.col("s")).alias("rest"))
    out = first.drop("cold", "miss", "times").join(sums, "uid", "left").join(rest, "uid", "left")
    nothing = F.lit(0)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("hot") + F.coalesce("rare", nothing)).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(n + 0.1 * (v + 1)))).alias("base_score"), (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"),
    )
