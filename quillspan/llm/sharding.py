"""Shards of near-equal bytes by sampled splitters.

Records are put in the order of (hash of the text, id). A size-weighted sample of those keys gives quantiles, which cut
the order into many ranges of about equal bytes; ranges that came out overfull are cut again by a sample of their own.
Exact running sums inside the ranges and exact range totals then give each record its byte offset in the whole order,
and the shard is the offset's sixteenth (or n-th) of all bytes. Equal texts stand next to each other, so copies share a
shard unless their group is cut by a boundary: a group of any size is spread over as many ranges as it needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspan.llm.common import materialise

#: Sampled keys for each range; the number of ranges is RANGES or more for each shard.
SAMPLE, RANGES, MOST_RANGES = 32, 4, 4096


def _range_of(cuts: np.ndarray):
    """Column function: the number of splitters (h, doc_id) that are not above the record's key."""
    heads, ids = cuts[:, 0].copy(), cuts[:, 1].copy()

    @F.arrow_udf("int")
    def of(h: pa.Array, doc_id: pa.Array) -> pa.Array:
        x, y = h.to_numpy(zero_copy_only=False), doc_id.to_numpy(zero_copy_only=False)
        lo, hi = np.searchsorted(heads, x, "left"), np.searchsorted(heads, x, "right")
        for i in np.flatnonzero(hi > lo):  # several splitters share this text: the id decides
            lo[i] += np.searchsorted(ids[lo[i] : hi[i]], y[i], "right")
        return pa.array(lo.astype(np.int32))

    return of


def _splitters(meta: DataFrame, n: int) -> np.ndarray:
    """n - 1 quantiles of a sample of n * SAMPLE keys, drawn with chances in proportion to size."""
    # The least values of -ln(u) / size are such a sample; u comes from a hash, so reruns agree.
    u = (F.xxhash64("h", "doc_id", F.lit("splitter")).bitwiseAND((1 << 52) - 1) + 1) / float(1 << 52)
    keys = meta.select("h", "doc_id", (-F.log(u) / F.col("size")).alias("rank")).orderBy("rank", "h", "doc_id").limit(n * SAMPLE)
    got = np.array(sorted((r["h"], r["doc_id"]) for r in keys.collect()), dtype=np.int64).reshape(-1, 2)
    if len(got) < n:
        return got
    return np.unique(got[np.arange(1, n) * len(got) // n], axis=0)


def shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", target_bytes: int = 64 << 20) -> DataFrame:
    """Put every record into one of n_shards shards of near-equal bytes.

    Returns doc_id, size (UTF-8 bytes plus 1; a null text has none), text_crc32 (of the UTF-8 bytes; 0 for null), law
    "bytes", shard, slot (gapless from 0 in a shard) and grown_shard (null under this law). A shard differs from its
    share by at most one record's size. Null ids are ordered before all others and stay null; repeated rows each get a slot of
    their own; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    meta = materialise(
        docs.select(
            F.col(id_col).alias("id"),
            F.coalesce(F.col(id_col), F.lit(-(1 << 63)).cast("long")).alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        ),
        "sizes",
    )
    total = meta.agg(F.sum("size")).first()[0] or 0
    n = int(min(MOST_RANGES, max(n_shards * RANGES, -(-total // target_bytes))))
    cuts = _splitters(meta, n)
    ranged = meta.withColumn("r", _range_of(cuts)(F.col("h"), F.col("doc_id")))
    held = {r["r"]: r["b"] for r in ranged.groupBy("r").agg(F.sum("size").alias("b")).collect()}  # at most n rows
    over = [r for r, b in held.items() if b > 2 * total / n]
    if over:
        wanted = [(r, -(-held[r] * n // total)) for r in over]
        inner = ranged.where(F.col("r").isin(over)).select("h", "doc_id", "size", "r")
        more = [_splitters(inner.where(F.col("r") == r), int(k)) for r, k in wanted]
        cuts = np.unique(np.concatenate([cuts, *more]), axis=0)
    ranged = meta.withColumn("r", _range_of(cuts)(F.col("h"), F.col("doc_id")))
    order = Window.partitionBy("r").orderBy("h", "doc_id", "size")
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    ranked = materialise(ranged.withColumns({"upto": F.sum("size").over(run), "row": F.row_number().over(order).cast("long")}), "ranked")
    sums = ranked.groupBy("r").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).orderBy("r").collect()
    bytes_before, rows_before, b, k = {}, {}, 0, 0
    for r in sums:
        bytes_before[r["r"]], rows_before[r["r"]] = b, k
        b, k = b + r["b"], k + r["n"]

    def lookup(of: dict[int, int], key: Column) -> Column:
        full = [of.get(i, 0) for i in range(len(cuts) + 1)]
        return F.element_at(F.lit(np.array(full, dtype=np.int64)) if full else F.array(F.lit(0)), key + 1).cast("long")

    # floor(n_shards * midpoint / total), in whole numbers
    middle = 2 * (lookup(bytes_before, F.col("r")) + F.col("upto")) - F.col("size")
    shard = F.expr("least(n_shards - 1, (n_shards * middle) div (2 * total))")
    placed = ranked.withColumns({"middle": middle, "n_shards": F.lit(n_shards).cast("long"), "total": F.lit(max(total, 1)).cast("long"), "place": lookup(rows_before, F.col("r")) + F.col("row") - 1})
    placed = placed.withColumn("shard", shard.cast("int"))
    first = {r["shard"]: r["p"] for r in placed.groupBy("shard").agg(F.min("place").alias("p")).collect()}  # n_shards rows
    starts = F.lit(np.array([first.get(i, 0) for i in range(n_shards)], dtype=np.int64))
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.element_at(starts, F.col("shard") + 1)).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
