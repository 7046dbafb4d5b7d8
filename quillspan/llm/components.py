"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.llm.common import discard, materialise


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of the edges (a, b): each node with the least node of its component, that node itself left out."""
    if not len(a):
        return a[:0], b[:0]
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        p, q = label[x], label[y]
        uneven = p != q
        if not uneven.any():
            break
        x, y, p, q = x[uneven], y[uneven], p[uneven], q[uneven]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while True:
            nearer = label[label]
            if (nearer == label).all():
                break
            label = nearer
    out = label != np.arange(len(nodes))
    return nodes[out], nodes[label[out]]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def _forest_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(rb.column(0).to_numpy(zero_copy_only=False), rb.column(1).to_numpy(zero_copy_only=False)) for rb in batches]
    if held:
        node, label = forest(*(np.concatenate(x) for x in zip(*held)))
        roots = np.unique(label)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([node, roots])), pa.array(np.concatenate([label, roots]))], names=["node", "label"])


def components(edges: DataFrame, small: int = 1 << 20) -> DataFrame:
    """Label every node of `edges` (columns a, b: long, not null) with the least node that it reaches.

    A graph of up to `small` edges, counted first, is one task's work (16 MB). A larger one
    alternates large-star and small-star steps until nothing changes; the number of rounds grows with the logarithm of
    the longest path. Every round is a written table, no edge reaches the driver, and the joins keep one side unique per
    node, so a hub's rows can be split over tasks. Empty input gives an empty result; loops are ignored.
    Returns node, label, the roots included.
    """
    now = materialise(edges.select("a", "b").where("a <> b").distinct(), "edges")
    if now.count() <= small:
        return materialise(now.coalesce(1).mapInArrow(_forest_of_task, "node long, label long"), "labels")
    seen = None
    while True:
        after = materialise(_small_star(_large_star(now).distinct()).distinct(), "stars")
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(now)
        now = after
        if state == seen or not state[0]:
            break
        seen = state
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
