"""Quality rules: base counts and a calibrated n-gram classifier, scored in Arrow batches.

Features are relative frequencies of hashed word unigrams and bigrams (A-Z lower-cased) and of sequences of 3 and 4 characters of the whole text.
A logistic regression is trained on the driver from a bounded sample of labelled rows (`sample` ids and `most_bytes` of vectors, those of least
hash, so that reruns agree); a fifth of them calibrate its scores to probabilities (Platt scaling). Everything else runs over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.llm import words as W
from quillspan.llm.common import discard, materialise, pieces, rows_a_batch, utf8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_ROW = np.uint64(0xC2B2AE3D27D4EB4F)
#: Hash bits of a feature group, and what relative frequencies are multiplied by for training.
BITS, SCALE = 14, 40.0
GROUPS = ("word", "two words", "three characters", "four characters")


def _per_row(at: np.ndarray, marked: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(marked)])[at])


def base_counts(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    n = len(at) - 1
    found = W.find_words(data, at)
    rolling = W.Rolling(data)
    words = rolling(found.starts, found.ends)
    out = {"n_words": np.diff(found.first), "word_chars": _per_row(at, ((data & 0xC0) != 0x80) & ~W.SPACE[data]), "n_symbols": _per_row(at, _SYMBOL[data])}
    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([at[:-1], breaks + 1]), kind="stable")
    row = np.repeat(np.arange(n), np.diff(np.searchsorted(breaks, at)) + 1)
    line_ends = np.append(line_starts[1:], at[-1]) if n else line_starts
    line_ends = np.where(row == np.append(row[1:], -1), line_ends - 1, at[1:][row]) if n else line_ends
    used = np.searchsorted(found.starts, line_starts) < np.searchsorted(found.starts, line_ends)
    row, key = row[used], W.mix(rolling(line_starts[used], line_ends[used]) + row[used].astype(np.uint64) * _ROW)
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(row, minlength=n) - np.bincount(row[first], minlength=n)
    three, where = W.grams(words, found.doc, 3)
    key = W.mix(three + found.doc[where].astype(np.uint64) * _ROW)
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    again = where[count[back] > 1]
    covered = np.zeros(len(words) + 2, bool)
    for i in range(3):
        covered[again + i] = True
    out["n_repeat_words"] = np.bincount(found.doc[covered[: len(words)]], minlength=n)
    return out


def _characters(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the row offsets into them."""
    first = (data & 0xC0) != 0x80
    if first.all():
        return data.astype(np.uint32), at
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.concatenate([[0], np.cumsum(first)])[at]


def features(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each group: the hashed feature of every n-gram, in row order, and the row offsets into them."""
    shift = np.uint64(64 - BITS)
    lower = W.LOWER[data]
    found = W.find_words(lower, at)
    h = W.Rolling(lower)(found.starts, found.ends)
    yield (h >> shift).astype(np.int32), found.first
    two, where = W.grams(h, found.doc, 2)
    yield (two >> shift).astype(np.int32), np.searchsorted(where, found.first)
    wide, ends = _characters(data, at)
    for k in (3, 4):
        key = np.zeros(max(len(wide) - k + 1, 0), np.uint32)
        for i in range(k):
            key = key * np.uint32(0x01000193) + wide[i : len(key) + i]
        key ^= key >> np.uint32(15)
        inside = np.ones(len(key), bool)
        for i in range(1, k):  # n-grams that would cross into the next row
            cross = ends[1:-1] - i
            inside[cross[(cross >= 0) & (cross < len(key))]] = False
        place = np.concatenate([[0], np.cumsum(inside)])[np.minimum(ends, len(key))]
        yield ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))[inside].astype(np.int32), place


class Model:
    """Weights of each group's hashed features, and Platt's two numbers."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 1.0, shift: float = 0.0):
        self.weights, self.bias, self.slope, self.shift = weights.reshape(len(GROUPS), -1), bias, slope, shift

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        z = np.full(len(at) - 1, self.bias)
        for w, (feature, place) in zip(self.weights, features(data, at), strict=True):
            total = np.concatenate([[0.0], np.cumsum(w[feature])])[place]
            z += np.diff(total) / np.maximum(np.diff(place), 1) * SCALE
        return z

    def probability(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -500, 500)))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse feature vectors: at most 4 * 2 ** BITS numbers each, whatever a text's length."""
    for rb in batches:
        data, at = utf8(rb.column(1))
        index, value = [], []
        for lo, hi in pieces(at):
            rows = [[] for _ in range(lo, hi)]
            for g, (feature, place) in enumerate(features(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])):
                for i in range(hi - lo):
                    own, n = np.unique(feature[place[i] : place[i + 1]], return_counts=True)
                    rows[i].append((own + (g << BITS), n * (SCALE / max(n.sum(), 1))))
            index += [np.concatenate([x for x, _ in r]).astype("<u2").tobytes() for r in rows]
            value += [np.concatenate([x for _, x in r]).astype("<f4").tobytes() for r in rows]
        yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(index, pa.binary()), pa.array(value, pa.binary())], names=["quality", "index", "value"])


class Sparse:
    """Rows of feature numbers and values, read where Arrow has them; products go block by block, so temporaries stay small."""

    def __init__(self, table: pa.Table, block: int = 128):
        table = table.combine_chunks()
        index, value = ((c.chunk(0) if c.num_chunks else pa.array([], pa.binary())).cast(pa.large_binary()) for c in (table.column("index"), table.column("value")))
        whole = lambda c, kind: np.frombuffer(c.buffers()[2], kind) if len(c) and c.buffers()[2] is not None else np.zeros(0, kind)
        self.index, self.value, self.block = whole(index, "<u2"), whole(value, "<f4"), block
        self.at = np.frombuffer(index.buffers()[1], np.int64)[: len(index) + 1] // 2 if len(index) else np.zeros(1, np.int64)

    def _blocks(self, rows: np.ndarray):
        for lo in range(0, len(rows), self.block):
            own = rows[lo : lo + self.block]
            size = (self.at[own + 1] - self.at[own]).astype(np.int64)
            take = np.repeat(self.at[own] - np.cumsum(size) + size, size) + np.arange(size.sum())
            yield slice(lo, lo + len(own)), np.repeat(np.arange(len(own)), size), self.index[take], self.value[take]

    def dot(self, rows: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows))
        for part, row, index, value in self._blocks(rows):
            out[part] = np.bincount(row, value * w[index], part.stop - part.start)
        return out

    def back(self, rows: np.ndarray, r: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros(width)
        for part, row, index, value in self._blocks(rows):
            out += np.bincount(index, value * r[part][row], width)
        return out


def _fit(x: Sparse, rows: np.ndarray, y: np.ndarray, width: int, ridge: float, rounds: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression with balanced classes, by accelerated gradient steps."""
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    v, c, size = np.ones(width), 1.0, 1.0
    for _ in range(8):  # the largest eigenvalue bounds the step
        r = weight * (x.dot(rows, v) + c)
        v, c = x.back(rows, r, width), r.sum()
        size = np.sqrt(v @ v + c * c)
        v, c = v / size, c / size
    step = 1 / (0.25 * size * 1.1 + ridge)
    w, b, u, d, t = np.zeros(width), 0.0, np.zeros(width), 0.0, 1.0
    for _ in range(rounds):
        r = weight * (1 / (1 + np.exp(-np.clip(x.dot(rows, u) + d, -500, 500))) - y)
        w1, b1, t1 = u - step * (x.back(rows, r, width) + ridge * u), d - step * r.sum(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, d = w1 + (t - 1) / t1 * (w1 - w), b1 + (t - 1) / t1 * (b1 - b)
        w, b, t = w1, b1, t1
    return w, b


def train(docs: DataFrame, labels: DataFrame, sample: int = 3000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", ridge: float = 1e-4, rounds: int = 120, most_bytes: int = 96 << 20) -> Model | None:
    """A model from at most `sample` labels; None if they don't hold both classes (then no verdict is given).

    Equal vectors with equal labels count once. Of more than `most_bytes` of vectors those of least hash are taken, so the
    driver's memory is bounded however long or often repeated the labelled texts are.
    """
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "quality").limit(sample)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")  # at most `sample` small rows
    vectors = rows.select(F.col("quality").cast("int").alias("quality"), "text").mapInArrow(_vectors, "quality int, index binary, value binary")
    with rows_a_batch(docs.sparkSession, 200):
        vectors = materialise(vectors.withColumn("h", F.xxhash64("index", "value")).dropDuplicates(["h", "quality"]), "vectors")
    # Bytes by the hash's first 12 bits: at most 4096 numbers tell where to cut.
    held = vectors.groupBy(F.shiftright("h", 52).alias("b")).agg(F.sum(F.octet_length("index") + F.octet_length("value")).alias("n"))
    last, total = -(1 << 11), 0
    for r in sorted(held.collect()):
        if total and total + r["n"] > most_bytes:
            break
        last, total = r["b"], total + r["n"]
    table = vectors.where(F.shiftright("h", 52) <= last).toArrow().sort_by([("h", "ascending"), ("quality", "ascending")])
    discard(vectors)
    y = table.column("quality").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return None
    held = np.arange(len(y)) % 5 == 4
    if len(set(y[~held].tolist())) < 2:
        held[:] = False
    x = Sparse(table)
    fit, check = np.flatnonzero(~held), np.flatnonzero(held) if held.any() else np.arange(len(y))
    w, b = _fit(x, fit, y[fit], len(GROUPS) << BITS, ridge, rounds)
    return Model(w, b, *_platt(x.dot(check, w) + b, y[check]))


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make 1 / (1 + exp(-slope * z - shift)) fit y, with Platt's smoothed targets."""
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    a = np.array([1.0, 0.0])
    x = np.stack([z, np.ones_like(z)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ x, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)) @ x.T + 1e-6 * np.eye(2), x @ (p - t))
        a -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return (float(a[0]), float(a[1])) if a[0] > 0 else (1.0, 0.0)


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"


def judge(docs: DataFrame, model: Model | None, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """docs with a struct column `quality_rules`: the base counts, base_failed, the model's probability and kept.

    Null texts have no words and so fail the base rules; without a model every text that passes those is kept. Repeated
    rows and other columns stay as they are; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    @F.arrow_udf(f"struct<{SCHEMA.replace(' ', ':').replace(',:', ',')}>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = held.value
        for col in batches:
            data, at = utf8(col)
            parts = []
            for lo, hi in pieces(at):
                raw, own = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
                got = base_counts(raw, own)
                n, again = got["n_words"], got["n_repeat_words"]
                got["base_failed"] = (n < 50) | (100 * again > 50 * n)
                got["probability"] = model.probability(model.scores(raw, own)) if model else np.ones(hi - lo)
                got["kept"] = ~got["base_failed"] & (got["probability"] >= threshold)
                parts.append(got)
            cols = [pa.array(np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, bool if c in ("base_failed", "kept") else float if c == "probability" else np.int64)) for c in names]
            yield pa.StructArray.from_arrays(cols, names=names)

    return docs.withColumn("quality_rules", of(F.col(text_col)))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id and the rules' results of every document, by a model trained from labels."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    return judge(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model).select("doc_id", "quality_rules.*")
