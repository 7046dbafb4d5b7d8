"""Mixing sources to target weights by entropy balancing.

Every source gets a token target. Document rates r in (0, cap) that stay as close as possible (in relative entropy,
with the cap as an upper bound) to 1 while meeting sum(r * size) = target are r = cap / (1 + exp(-l * size / scale)) for
cap 2, with one dual variable l for each source. The dual is convex; Newton iterations, safeguarded by a bracket, solve it for all sources at
once over the table of distinct (source, size) with counts. The rates are then rounded to copies 0, 1 or 2: sizes of a
source are visited from the largest to the smallest, and each size's total of copies carries the error of the sizes
before it, so that a source's words end within about the smallest size of the target.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from quillspan.llm.common import WORD, materialise, row_key

CAP = 2.0


def targets(sizes: Sequence[float], weights: Sequence[float], share: float) -> list[float]:
    """share * sum(sizes) dealt out by weight, at most CAP * size each; the excess is dealt to the others by weight."""
    left, free, out = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        level = left / sum(weights[i] for i in free)
        full = [i for i in free if level * weights[i] >= CAP * sizes[i]]
        if not full:
            for i in free:
                out[i] = level * weights[i]
            break
        for i in full:
            out[i] = CAP * sizes[i]
            left -= out[i]
            free.discard(i)
    return out


def _rate(dual, scaled):
    return CAP / (1 + np.exp(-np.clip(dual * scaled, -700, 700)))


def solve(hist: DataFrame, goal: dict[str, tuple[float, float]], rounds: int = 60, tolerance: float = 1e-9) -> dict[str, float]:
    """Dual variables by source. hist: src, size, n. goal: (target, scale) by source; the driver holds a row a source.

    A source that isn't within the tolerance after all rounds keeps its last value, and the log says so: rounding still
    carries its error from size to size, so its copies follow its rates and not its target.
    """
    spark = hist.sparkSession
    state = {s: [0.0, -np.inf, np.inf] for s, (t, scale) in goal.items() if t > 0}
    done: dict[str, float] = {}
    for _ in range(rounds):
        if not state:
            break
        now = spark.createDataFrame([(s, v[0], goal[s][1]) for s, v in state.items()], "src string, dual double, scale double")
        x = F.col("size") / F.col("scale")
        r = CAP / (1 + F.exp(-F.greatest(F.least(F.col("dual") * x, F.lit(700.0)), F.lit(-700.0))))
        sums = hist.join(now, "src").groupBy("src").agg(F.sum(F.col("n") * x * r).alias("g"), F.sum(F.col("n") * x * x * r * (1 - r / CAP)).alias("h")).collect()
        for row in sums:
            s, (t, scale), v = row["src"], goal[row["src"]], state[row["src"]]
            gap = row["g"] - t / scale
            if abs(gap) <= tolerance * t / scale:
                done[s] = state.pop(s)[0]
                continue
            v[1], v[2] = (v[0], v[2]) if gap < 0 else (v[1], v[0])
            step = v[0] - gap / row["h"] if row["h"] > 0 else np.nan
            if not v[1] < step < v[2]:  # leave the bracket's outside to bisection, or double while it is open
                step = (v[1] + v[2]) / 2 if np.isfinite(v[1] + v[2]) else (2 * v[0] or 1.0) if gap < 0 and v[0] >= 0 else (2 * v[0] or -1.0) if gap > 0 and v[0] <= 0 else 0.0
            v[0] = float(step)
    if state:
        logging.getLogger(__name__).warning("%d sources are not within %g of their targets after %d rounds", len(state), tolerance, rounds)
    return done | {s: v[0] for s, v in state.items()}


def _round(pdf: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for each size of a source, from its rates; the error in words is carried from size to size."""
    pdf = pdf.sort_values("size", ascending=False)
    owed, copies = 0.0, []
    for size, n, rate in zip(pdf["size"], pdf["n"], pdf["rate"], strict=True):
        k = n if size == 0 else min(max(round(n * rate + owed / size), 0), int(CAP) * n)
        owed += size * (n * rate - k)
        copies.append(int(k))
    return pdf[["src", "size", "n"]].assign(copies=copies)


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", hot: int = 20_000
) -> tuple[DataFrame, DataFrame]:
    """How often each document enters the mix.

    Sources are taken in code point order, null last, and weigh weights[0], weights[1], ... over again. Returns (sizes,
    copies): doc_id, k1 and k2 (the row_key() of the whole row), source and size of every document, and the same with source_size, target, rate and copies. Null texts and
    texts without a word have size 0 and one copy. Only rows that are equal in all columns are interchangeable; an empty
    table gives an empty result. hot: documents of one source and size that one task ranks; more are cut by hash.
    """
    spark = docs.sparkSession
    text, (k1, k2) = F.coalesce(F.col(text_col), F.lit("")), row_key(docs)
    meta = materialise(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), k1.alias("k1"), k2.alias("k2"),
            F.when(F.col(source_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(source_col))).alias("src"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        ),
        "words",
    )
    hist = materialise(meta.groupBy("src", "size").agg(F.count(F.lit(1)).alias("n")), "hist")
    by = {r["src"]: r for r in hist.groupBy("src").agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs")).collect()}
    names = sorted(by, key=lambda s: (s == "", s))
    goals = targets([by[s]["words"] for s in names], [weights[i % len(weights)] for i in range(len(names))], share)
    free = {s: (t, by[s]["words"] / by[s]["docs"]) for s, t in zip(names, goals, strict=True) if 0 < t < CAP * by[s]["words"]}
    dual = solve(hist, free)
    rows = [(s, int(by[s]["words"]), float(t), dual.get(s), max(by[s]["words"] / by[s]["docs"], 1e-9)) for s, t in zip(names, goals, strict=True)]
    sources = spark.createDataFrame(rows, "src string, source_size long, target double, dual double, scale double")
    rate = F.when(F.col("dual").isNull(), CAP).otherwise(CAP / (1 + F.exp(-F.greatest(F.least(F.col("dual") * F.col("size") / F.col("scale"), F.lit(700.0)), F.lit(-700.0)))))
    rated = hist.join(sources, "src").withColumn("rate", rate)
    wanted = rated.groupBy("src").applyInPandas(_round_group, "src string, size long, n long, rate double, copies long, source_size long, target double")
    wanted = materialise(wanted, "copies")
    # Of n documents of one source and size, copies mod n get one more than the others: those first by hash.
    dealt = meta.join(wanted, ["src", "size"]).withColumn("part", F.pmod("k1", F.ceil(F.col("n") / hot).cast("long")))
    rank = F.row_number().over(Window.partitionBy("src", "size", "part").orderBy("k1", "k2"))
    before = wanted.where(F.col("n") > hot).select("src", "size", "n")
    held = meta.join(before, ["src", "size"]).groupBy("src", "size", F.pmod("k1", F.ceil(F.col("n") / hot).cast("long")).alias("part")).agg(F.count(F.lit(1)).alias("held"))
    upto = F.sum("held").over(Window.partitionBy("src", "size").orderBy("part")) - F.col("held")
    offsets = held.select("src", "size", "part", upto.alias("before"))
    placed = dealt.withColumn("rank", rank).join(offsets, ["src", "size", "part"], "left")
    more = (F.coalesce("before", F.lit(0)) + F.col("rank") <= F.expr("copies % n")).cast("long")
    return meta, placed.select("doc_id", "k1", "k2", "source", "size", "source_size", "target", "rate", (F.expr("copies div n") + more).alias("copies"))


def _round_group(pdf: pd.DataFrame) -> pd.DataFrame:
    out = _round(pdf)
    cols = pdf.loc[out.index, ["rate", "source_size", "target"]]
    return out.assign(rate=cols["rate"], source_size=cols["source_size"], target=cols["target"])[["src", "size", "n", "rate", "copies", "source_size", "target"]]
