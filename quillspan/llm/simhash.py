"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint holds 64 majority bits of a text's shingle hashes. Texts whose fingerprints differ in at most `radius`
bits are linked; linked texts form groups. The search is exact:

1. Bit statistics (a 64 x 64 table of joint counts, over all fingerprints) group correlated bits into partitions.
2. Thresholds t_i with sum(t_i) = radius - partitions + 1 (t_i = -1 leaves a partition out) guarantee that two
   fingerprints within the radius are within t_i in some partition i. Dynamic programming allots them so that the
   estimated cost of probes and candidates is least; the number of partitions is chosen the same way.
3. Every fingerprint is put under its own partition value and, as a probe, under each larger value within t_i. A pair
   within t_i meets under the larger value. Values that only one row has are dropped before anything else.
4. Rows of a value are verified in NumPy with XOR and bit counts, and only spanning edges leave a task, so a group of n
   copies costs O(n) rows. A value with more than `heavy` rows is cut into blocks, and pairs of blocks are spread over tasks.
5. Spanning edges are joined to components by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb, exp, lgamma

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillspan.llm.common import ASCII_LOWER, SEED, discard, materialise, row_key, rows_a_batch, utf8
from quillspan.llm.components import components, forest

#: Eight 0/1 bytes for each byte value, lowest bit first.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """XXH64 of each k-word shingle, repeats included; of the whole sequence if it has fewer words."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = map(b" ".join, zip(*(words[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
    return np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.uint64)


def majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes: a bit is 1 if it is set in over half of them. ends: run ends."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    out = np.zeros(len(ends), np.uint64)
    full = np.flatnonzero(ends > starts)
    if not len(full):
        return out
    # Byte lanes overflow after 255 rows, so runs are cut there first.
    cuts = np.concatenate([np.arange(starts[i], ends[i], 255) for i in full])
    lanes = SPREAD[hashes.view(np.uint8).reshape(-1, 8)]
    parts = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).reshape(len(cuts), 64)
    counts = np.add.reduceat(parts, np.searchsorted(cuts, starts[full]), axis=0, dtype=np.int64)
    bits = 2 * counts > (ends - starts)[full][:, None]
    out[full] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint_column(text: Column, k: int) -> Column:
    """64-bit fingerprint (as a signed long) of a text column; null and blank texts get 0."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            data, at = utf8(col)
            raw = data.tobytes().translate(ASCII_LOWER)
            out = np.zeros(len(col), np.uint64)
            lo = 0
            while lo < len(col):  # about 200,000 hashes at a time
                got, ends, n, hi = [], [], 0, lo
                while hi < len(col) and n < 200_000:
                    h = shingle_hashes(raw[at[hi] : at[hi + 1]].split(), k)
                    got.append(h)
                    n += len(h)
                    ends.append(n)
                    hi += 1
                out[lo:hi] = majority(np.concatenate(got), np.array(ends, np.int64))
                lo = hi
            yield pa.array(out.view(np.int64))

    return of(text)


# --- plan: partitions and thresholds -------------------------------------------------------------------------------


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for bits i and j, in how many both are set; over all rows, 64 x 64 numbers."""

    def joint(batches):
        total = np.zeros((64, 64))
        n = 0
        for rb in batches:
            x = np.ascontiguousarray(rb.column(0).to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
            for lo in range(0, len(x), 8192):
                bits = np.unpackbits(x[lo : lo + 8192], axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
                n += len(bits)
        cells = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097)), pa.array(cells)], names=["cell", "n"])

    rows = fps.select("fp").mapInArrow(joint, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(4097)
    for r in rows:
        cells[r["cell"]] = r["n"]
    return int(cells[4096]), cells[:4096].reshape(64, 64)


def group_bits(n: int, joint: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of about equal width; each is grown from the bits most correlated with those it has."""
    p = np.diag(joint) / max(n, 1)
    cov = joint / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    near = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(near, 0)
    free, out = set(range(64)), []
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        own = [max(sorted(free), key=lambda b: near[b, sorted(free)].max())]
        free.discard(own[0])
        while len(own) < width:
            own.append(max(sorted(free), key=lambda b: near[b, own].sum()))
            free.discard(own[-1])
        out.append(sorted(own))
    return out


def within(n: int, joint: np.ndarray, bits: list[int], most: int) -> list[float]:
    """Estimated share of random pairs that differ in at most 0..most of the bits.

    The number of differing bits is taken as beta-binomial with the mean and variance that the joint counts imply.
    """
    if n < 2:
        return [1.0] * (most + 1)
    p, w = np.diag(joint)[bits] / n, len(bits)
    p11 = joint[np.ix_(bits, bits)] / n
    p10, p01 = p[:, None] - p11, p[None, :] - p11
    both = 2 * (p11 * (1 - p[:, None] - p[None, :] + p11) + p10 * p01)
    d = 2 * p * (1 - p)
    np.fill_diagonal(both, d)
    mean, var = d.sum(), (both - np.outer(d, d)).sum()
    q = min(max(mean / w, 1e-6), 1 - 1e-6)
    rho = min(max((var / max(w * q * (1 - q), 1e-12) - 1) / max(w - 1, 1), 1e-4), 0.99)
    a, b = q * (1 / rho - 1), (1 - q) * (1 / rho - 1)
    beta = lambda x, y: lgamma(x) + lgamma(y) - lgamma(x + y)
    pmf = [comb(w, k) * exp(beta(k + a, w - k + b) - beta(a, b)) for k in range(min(most, w) + 1)]
    return [min(1.0, max(float(sum(pmf[: k + 1])), 2.0**-w)) for k in range(most + 1)]


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of least summed cost with the given sum. costs[i][t + 1] is that of threshold t from -1 on."""
    best = {0: (0.0, [])}
    for row in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for have, (c, ts) in best.items():
            for t, x in enumerate(row, -1):
                cand = (c + x, [*ts, t])
                if cand[0] < after.get(have + t, (float("inf"),))[0]:
                    after[have + t] = cand
        best = after
    return best.get(total, (float("inf"), []))


def plan(n: int, joint: np.ndarray, radius: int, row_cost: float = 1.0, pair_cost: float = 0.004) -> list[tuple[list[int], int]]:
    """Partitions with thresholds (those that are left out are not in the list)."""
    best, chosen = float("inf"), []
    for m in range(1, radius + 2):
        parts = group_bits(n, joint, m)
        costs = []
        for bits in parts:
            near, row, ball = within(n, joint, bits, radius), [0.0], 0
            for t in range(radius + 1):
                ball += comb(len(bits), t) if t <= len(bits) else 0
                row.append(n * (1 + ball) / 2 * row_cost + n * n / 2 * near[t] * pair_cost if ball <= 4000 else float("inf"))
            costs.append(row)
        cost, ts = allot(costs, radius - m + 1)
        if cost < best:
            best, chosen = cost, [(b, t) for b, t in zip(parts, ts, strict=True) if t >= 0]
    return chosen


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# --- candidates and verification -----------------------------------------------------------------------------------


def _pairs_of_batch(group, own, fp, radius, small=48):
    """Pairs of rows of a group, one of them its own value's, that differ in at most radius bits, thinned out within large groups."""
    u = fp.view(np.uint64)
    left, right = [], []
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(group)))
    ok = np.repeat(sizes <= small, sizes)
    for d in range(1, min(small, int(sizes.max(initial=1)))):
        i = np.flatnonzero((group[:-d] == group[d:]) & ok[:-d])
        if not len(i):
            break
        apart = np.bitwise_count(u[i] ^ u[i + d])
        i = i[(own[i] | own[i + d]) & (apart <= radius) & (apart > 0)]
        left.append(fp[i])
        right.append(fp[i + d])
    for s, n in zip(starts[sizes > small], sizes[sizes > small], strict=True):
        x, o = u[s : s + n], own[s : s + n]
        for lo in range(0, n, 256):
            apart = np.bitwise_count(x[lo : lo + 256, None] ^ x[None, lo:])
            near = (apart <= radius) & (apart > 0) & (o[lo : lo + 256, None] | o[None, lo:])
            i, j = np.nonzero(near)
            i, j = s + lo + i, s + lo + j
            a, b = forest(fp[i], fp[j])
            left.append(a)
            right.append(b)
    if not left:
        return fp[:0], fp[:0]
    return np.concatenate(left), np.concatenate(right)


def _verify(radius: int, most: int = 200_000):
    def run(batches):
        kept = None
        near, far = [], []

        def add(group, own, fp):
            a, b = _pairs_of_batch(group, own, fp, radius)
            near.append(a)
            far.append(b)
            if sum(map(len, near)) > most:
                thin()

        def thin():
            stars.append(forest(np.concatenate(near), np.concatenate(far)))
            near.clear()
            far.clear()

        stars = []
        for rb in batches:
            cols = [rb.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if kept is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(kept, cols, strict=True)]
            part, key, cell, own, fp = cols
            if not len(fp):
                continue
            new = (part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
            group = np.concatenate([[0], np.cumsum(new)])
            last = int(np.searchsorted(group, group[-1]))
            kept = [c[last:] for c in cols]  # the last group may go on in the next batch
            if last:
                add(group[:last], own[:last], fp[:last])
            if len(stars) > 16:
                stars[:] = [forest(*(np.concatenate(x) for x in zip(*stars)))]
        if kept is not None and len(kept[4]):
            add(np.zeros(len(kept[4]), np.int64), kept[3], kept[4])
        if near:
            thin()
        if stars:
            p, q = forest(*(np.concatenate(x) for x in zip(*stars)))
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(q)], names=["a", "b"])

    return run


def links(fps: DataFrame, radius: int, heavy: int = 4096) -> DataFrame:
    """Spanning edges (a, b) of the graph that joins fingerprints (column fp, distinct) within `radius` bits."""
    spark = fps.sparkSession
    n, joint = bit_statistics(fps)
    probes = []
    for i, (bits, t) in enumerate(plan(n, joint, radius)):
        mask = sum(1 << b for b in bits)
        for size in range(t + 1):
            for flip in combinations(bits, size):
                probes.append((i, signed(mask), signed(sum(1 << b for b in flip))))
    if not probes or n < 2:
        return spark.createDataFrame([], "a long, b long")
    lit = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("m"), F.lit(x).alias("x")) for i, m, x in probes])
    value = F.col("fp").bitwiseAND(F.col("p.m"))
    rows = (
        fps.select("fp", F.explode(lit).alias("p"))
        .select(F.col("p.i").alias("part"), value.bitwiseXOR(F.col("p.x")).alias("key"), (F.col("p.x") == 0).alias("own"), "fp", value.alias("v"))
        .where("key >= v")
    )
    # Counts are summed before the shuffle, so that no task holds all rows of a heavy value.
    shared = rows.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("owned")).where("n > 1 and owned").drop("owned")
    rows = materialise(rows.join(shared, ["part", "key"]).select("part", "key", "own", "fp", "n"), "candidates")
    light = rows.where(F.col("n") <= heavy).select("part", "key", F.lit(0).cast("long").alias("cell"), "own", "fp")
    # A heavy value's rows are cut into blocks; cell x * blocks + y holds blocks x <= y.
    blocks = F.ceil(F.col("n") / heavy).cast("long")
    cells = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda y: F.least(y, F.col("block")) * F.col("blocks") + F.greatest(y, F.col("block")))
    hot = rows.where(F.col("n") > heavy).withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("fp"), blocks)}).select("part", "key", F.explode(cells).alias("cell"), "own", "fp")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = light.union(hot).repartition(width, "part", "key", "cell").sortWithinPartitions("part", "key", "cell")
    return dealt.mapInArrow(_verify(radius), "a long, b long")


# --- operators -----------------------------------------------------------------------------------------------------


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp of every document."""
    return docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), shingle).alias("fp"))


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and group of every document.

    Returns doc_id, fingerprint (16 lower-case hex digits) and component_id, the least id that the document reaches over
    links. Null and blank texts have fingerprint zero and are linked like any other; rows with a null id get the least
    id of their group, null if it has none; repeated rows stay; an empty table gives an empty result. Other columns of
    docs are not read.
    """
    own = materialise(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    labels = components(links(nodes, radius))
    labelled = nodes.join(labels, nodes.fp == labels.node, "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    least = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    groups = labelled.select("fp", "label").join(least, "label").select("fp", "component_id")
    return own.join(groups, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_sets(text: Column, k: int) -> Column:
    """Distinct shingle hashes of a text column."""

    @F.arrow_udf("array<long>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            data, at = utf8(col)
            raw = data.tobytes().translate(ASCII_LOWER)
            sets = [np.unique(shingle_hashes(raw[at[i] : at[i + 1]].split(), k)).view(np.int64) for i in range(len(col))]
            yield pa.array(sets, pa.list_(pa.int64()))

    return of(text)


def parity_bits(hashes: np.ndarray) -> np.ndarray:
    """A bitmap of a set of hashes: bit i is the parity of how many are i modulo its size.

    Its size is the least power of two, 64 at least, that isn't under the set's. The bits in which the bitmaps of two
    sets differ are at most as many as the hashes that only one of them has.
    """
    size = 1 << max(6, int(len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def may_be_similar(x: bytes, y: bytes, m: int, n: int, similarity: float) -> bool:
    """False only if sets of m and n hashes with these bitmaps have a Jaccard similarity below the given one."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b):  # a larger table is folded onto the smaller one's size
        a = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(a ^ b).sum()) <= (1 - similarity) / (1 + similarity) * (m + n) + 1e-6


def sketches(text: Column, k: int, similarity: float, common) -> Column:
    """What the search needs of a text: fingerprint fp, and of its set of shingle hashes a hash t, the size, the parity
    bits and the prefix, whose first `rare` hashes aren't in the broadcast `common` (sorted).

    Sets are ordered by hash, those in `common` last. Two sets of at least the given Jaccard similarity share a hash
    within both prefixes: all but the last ceil(similarity * size) - 1 hashes.
    """

    @F.arrow_udf("struct<fp: long, t: long, size: int, bits: binary, rare: int, prefix: array<long>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        late_ones = common.value
        for col in batches:
            data, at = utf8(col)
            raw = data.tobytes().translate(ASCII_LOWER)
            fps, keys, sizes, bits, early, prefixes = [], [], [], [], [], []
            for i in range(len(col)):
                h = shingle_hashes(raw[at[i] : at[i + 1]].split(), k)
                fps.append(majority(h, np.array([len(h)], np.int64)))
                own = np.unique(h)
                keys.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                sizes.append(len(own))
                bits.append(parity_bits(own).tobytes())
                n = len(own)
                if len(late_ones) and n:
                    late = late_ones[np.minimum(np.searchsorted(late_ones, own), len(late_ones) - 1)] == own
                    n -= int(late.sum())
                    own = np.concatenate([own[~late], own[late]])
                early.append(n)
                prefixes.append(own[: len(own) - int(np.ceil(similarity * len(own) - 1e-6)) + 1].view(np.int64))
            fp = np.concatenate(fps).view(np.int64) if fps else np.zeros(0, np.int64)
            cols = [pa.array(fp), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(bits, pa.binary()), pa.array(early, pa.int32()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.StructArray.from_arrays(cols, names=["fp", "t", "size", "bits", "rare", "prefix"])

    return of(text)


def common_shingles(docs: DataFrame, shingle: int, text_col: str, share: int = 8, least: int = 4, most: int = 500_000) -> np.ndarray:
    """Sorted hashes of the shingles that `least` or more different texts of one in `share` have, the `most` frequent of them.

    They only set the order of prefixes, and so the cost of the search; what it finds is the same for any order. The
    sample is a share of all texts, so a hash that isn't among them is in about least * share texts at most, whatever
    the table's size.
    """
    text = F.col(text_col)
    some = docs.where(F.pmod(F.xxhash64(text), F.lit(share)) == 0).select(text.alias("x")).distinct()
    found = some.select(F.explode(shingle_sets(F.col("x"), shingle)).alias("h")).groupBy("h").count().where(F.col("count") >= least)
    found = found.orderBy(F.desc("count"), "h").limit(most)
    return np.sort(found.select("h").toArrow().column("h").to_numpy().view(np.uint64))


def prefix_index(own: DataFrame) -> DataFrame:
    """h, t, size, at and n: for each hash that prefixes of several sets have, those sets, the place in them and their number.

    Hashes that a sample showed to be common are counted before the shuffle, so no task gets all rows of one; any other
    is in few of the sets and its rows are counted where they meet.
    """
    sets = own.groupBy("t").agg(F.any_value(F.struct("size", "rare", "prefix")).alias("i"))
    rows = sets.select("t", "i.size", "i.rare", F.posexplode("i.prefix").alias("at", "h"))
    seldom = rows.where("at < rare").select("h", "t", "size", "at").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("h"))).where("n > 1")
    often = rows.where("at >= rare").select("h", "t", "size", "at")
    counts = often.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return materialise(seldom.unionByName(often.join(counts, "h")), "prefixes")


def verified(pairs: DataFrame, items: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Of pairs (x, y) of sets, the fingerprints (a, b) of those whose Jaccard similarity is at least the given one.

    Parity bits rule out nearly all others without their texts; the sets of the rest are made and compared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            cols = [rb.column(c).to_pylist() for c in ("bx", "by", "m", "n")]
            keep = [may_be_similar(*row, similarity) for row in zip(*cols, strict=True)]
            yield rb.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    one, two = (items.select(F.col("t").alias(i), F.col("bits").alias("b" + i), F.col("size").alias(size)) for i, size in (("x", "m"), ("y", "n")))
    pairs = materialise(pairs.join(one, "x").join(two, "y").select("x", "y", "bx", "by", "m", "n").mapInArrow(run, "x long, y long"), "survivors")
    wanted = pairs.select(F.col("x").alias("t")).union(pairs.select("y")).distinct().join(items.select("t", "fp", "k1", "k2"), "t")
    held = texts.join(wanted, ["k1", "k2"]).dropDuplicates(["t"])
    with rows_a_batch(texts.sparkSession, 1000):
        sets = materialise(held.select("t", "fp", shingle_sets(F.col("text"), shingle).alias("s")), "sets")
    x, y = (sets.select(F.col("t").alias(i), F.col("fp").alias(fp), F.col("s").alias("s" + i)) for i, fp in (("x", "a"), ("y", "b")))
    both = F.size(F.array_intersect("sx", "sy"))
    found = pairs.join(x, "x").join(y, "y").where(both >= similarity * (F.size("sx") + F.size("sy") - both) - 1e-9)
    found = materialise(found.where("a != b").select("a", "b").distinct(), "verified")
    for done in (sets, pairs):
        discard(done)
    return found


def similar(own: DataFrame, texts: DataFrame, edges: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Edges (a, b) between fingerprints, such that with `edges` they join all texts of at least the given similarity.

    own: k1, k2, fp and the rest of sketches() for each row; texts: k1, k2 and text. Sets that share a hash of their
    prefixes are all compared, but for those that links join already. So that a group of many like texts doesn't
    compare each pair, a first round compares, for each hash, one text of each part of the graph with the part's that
    has most in common with others, and with the next in size; the second takes every pair that is still apart.
    """
    meta = materialise(own.drop("prefix", "rare"), "meta")
    items = materialise(meta.groupBy("t").agg(F.min(F.struct("fp", "k1", "k2", "size", "bits")).alias("i")).select("t", "i.*"), "items")
    same = materialise(meta.join(items.select("t", F.col("fp").alias("b")), "t").where("fp != b").select(F.col("fp").alias("a"), "b").distinct(), "same")
    discard(meta)
    rows = prefix_index(own)
    edges = edges.select("a", "b").union(same)

    def parted() -> DataFrame:
        labels = components(edges).select(F.col("node").alias("fp"), "label")
        part = items.select("t", "fp").join(labels, "fp", "left").select("t", F.coalesce("label", "fp").alias("part"))
        return rows.join(part, "t")

    def reach(at: str, other_at: str, size: str, other_size: str) -> Column:  # what both can share from here on is enough
        most = F.least(F.col(size) - F.col(at), F.col(other_size) - F.col(other_at))
        return most >= similarity / (1 + similarity) * (F.col(size) + F.col(other_size)) - 1e-6

    pair = [F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")]
    weight = rows.groupBy("t").agg(F.sum("n").alias("w"))
    spots = materialise(parted().join(weight, "t").groupBy("h", "part").agg(F.max(F.struct("w", "t", "size", "at")).alias("m"), F.max("n").alias("n")).select("h", "part", "n", "m.*"), "spots")
    centre = spots.groupBy("h").agg(F.max(F.struct("w", "t", "size", "at")).alias("c"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    centre = centre.select("h", F.col("c.t").alias("y"), F.col("c.size").alias("size2"), F.col("c.at").alias("at2"))
    stars = spots.withColumnRenamed("t", "x").join(centre, "h").where(reach("at", "at2", "size", "size2")).where("x != y").select(*pair)
    # Neighbours in size; rows of a hash that many sets have are dealt out, each to one of as many lists as keeps them short.
    lists = F.pmod(F.xxhash64("t", "h"), F.ceil(F.col("n") / 4096).cast("long"))
    by = Window.partitionBy("h", lists).orderBy("size", "t")
    nexts = spots.select("h", F.col("t").alias("x"), "size", "at", F.lead("t").over(by).alias("y"), F.lead("size").over(by).alias("size2"), F.lead("at").over(by).alias("at2"))
    nexts = nexts.where("y is not null").where(reach("at", "at2", "size", "size2")).select(*pair)
    first = materialise(stars.union(nexts).distinct(), "pairs")
    found = verified(first, items, texts, shingle, similarity)
    discard(spots)

    edges = edges.union(found)
    now = materialise(parted(), "parts")
    apart = now.groupBy("h").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("h")
    now = now.join(apart, "h")
    other = now.select("h", F.col("t").alias("y"), F.col("size").alias("size2"), F.col("at").alias("at2"), F.col("part").alias("part2"))
    rest = now.withColumnRenamed("t", "x").join(other, "h").where("part < part2").where(reach("at", "at2", "size", "size2")).select(*pair).distinct()
    rest = materialise(rest.join(first, ["x", "y"], "left_anti"), "pairs")
    last = verified(rest, items, texts, shingle, similarity)
    for done in (now, first, rest, rows, items):
        discard(done)
    return same.union(found).union(last)


def representatives(docs: DataFrame, shingle: int = 5, sure: int = 4, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, one for each group of near-duplicates: that of least id.

    Fingerprints within `sure` bits are linked, and texts whose shingle sets' Jaccard similarity is at least `similarity`,
    however far their fingerprints are apart. Rows with a null id stay only if all of their group have none; of equal
    rows one stays; blank texts form one group; an empty table gives an empty result; all columns are kept as they are,
    whatever their names.
    """
    k1, k2 = row_key(docs)
    with rows_a_batch(docs.sparkSession, 1000):
        common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, shingle, text_col))
    own = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(id_col).alias("id"), sketches(F.col(text_col), shingle, similarity, common).alias("s"))
    with rows_a_batch(docs.sparkSession, 2000):
        own = materialise(own.select("k1", "k2", "id", "s.*"), "rows")
    near = materialise(links(materialise(own.select("fp").distinct(), "nodes"), sure), "links")
    like = similar(own.drop("id"), docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text")), near, shingle, similarity)
    labels = components(near.union(like))
    labelled = own.join(labels, own.fp == labels.node, "left").select("k1", "k2", "id", F.coalesce("label", "fp").alias("label"))
    first = labelled.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")).alias("w"), F.count(F.lit(1)).alias("n")).select("w.k1", "w.k2", "n")
    first = materialise(first, "chosen")
    # Equal rows have one key: of a chosen row that occurs several times one is kept.
    copies = materialise(own.groupBy("k1", "k2").count().where("count > 1").join(first, ["k1", "k2"], "left_semi").select("k1", "k2"), "copies")
    keyed = docs.select(F.struct(*docs.columns).alias("r"), k1.alias("k1"), k2.alias("k2"))
    kept = keyed.join(first, ["k1", "k2"], "left_semi")
    if not copies.isEmpty():
        once = kept.join(copies, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
        kept = kept.join(copies, ["k1", "k2"], "left_anti").unionByName(once)
    discard(own)
    return kept.select("r.*")
