"""Centroid clustering: Lloyd's rounds over two trees, one over the vectors and one over each round's centroids.

Every task builds cover trees over blocks of its own vectors, so that no vector is shuffled and no value of a vector can
make a group too large. A tree's nodes hold how many vectors they cover and their sum. In a round a pair of nodes, one of
each tree, is dropped where the distance of their centres and their radii show that another centroid is nearer to all
vectors of the one than any centroid of the other; a node with one centroid left is counted as a whole by its sum, and only
leaves with several left compare vectors with centroids, in integers. Results are those of plain Lloyd rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillspan.llm.common import discard, materialise, rows_a_batch

#: Vectors in a tree, in a leaf, and children of a node at most.
BLOCK, LEAF, FAN = 8192, 16, 24
#: Components of at most this size keep squared distances of up to 256 components within 64 bits.
LARGEST = 1 << 27


@dataclass
class Tree:
    """Nodes in breadth-first order: the first is the root, a node's children stand together, its points too."""

    points: np.ndarray  # int64, a row a vector, leaf by leaf
    order: np.ndarray  # the input's row of each point
    centre: np.ndarray  # point at a node's centre
    radius: np.ndarray  # largest distance of a point of the node from its centre
    first: np.ndarray  # points [first, last) are the node's
    last: np.ndarray
    child: np.ndarray  # nodes [child, child + children) are its children, none for a leaf
    children: np.ndarray


def _apart(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    d = points - to
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def cover_tree(points: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> Tree:
    """Children of a node are picked farthest first, the node's own centre being the first, until all its points lie within
    half its radius or there are `fan`: each child then covers the points nearest to it, and the centres are farther apart
    than any point is from its own. Equal points are one leaf, however many.
    """
    x, order = points.astype(np.float64), np.arange(len(points))
    nodes = [(0, 0, len(points), 0.0)] if len(points) else []
    centre, radius, first, last, child, children = ([] for _ in range(6))
    at = 0
    while at < len(nodes):
        mid, lo, hi, _ = nodes[at]
        own = order[lo:hi]
        d = _apart(x[own], x[mid])
        wide = float(d.max())
        for to, v in zip((centre, radius, first, last, child, children), (mid, wide, lo, hi, len(nodes), 0), strict=True):
            to.append(v)
        if hi - lo > leaf and wide > 0:
            picked, nearest = [mid], np.zeros(hi - lo, np.int64)
            while len(picked) < fan and (far := float(d.max())) > wide / 2:
                new = int(d.argmax())
                e = _apart(x[own], x[own[new]])
                closer = e < d
                d = np.where(closer, e, d)
                nearest[closer] = len(picked)
                picked.append(int(own[new]))
                if far == 0:
                    break
            sort = np.argsort(nearest, kind="stable")
            order[lo:hi] = own[sort]
            edges = np.searchsorted(nearest[sort], np.arange(len(picked) + 1))
            children[at] = len(picked)
            nodes += [(p, lo + int(a), lo + int(b), 0.0) for p, a, b in zip(picked, edges, edges[1:], strict=False)]
        at += 1
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    whole = lambda v: np.array(v, np.int64)
    return Tree(points[order], order, place[whole(centre)], np.array(radius, np.float64), whole(first), whole(last), whole(child), whole(children))


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for each i, counts[i] of them."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def assign(tree: Tree, centroids: np.ndarray, over: Tree | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(nodes that go as a whole to one centroid, that centroid by node; the points of all other leaves have theirs in the third
    part of the result). Returned as: centroid of each node or -1, centroid of each point, exact comparisons made.

    Bounds are taken with a slack above the error of double precision, so that a tie is always compared exactly.
    """
    over = over or cover_tree(centroids, leaf=1)
    x, c = tree.points.astype(np.float64), over.points.astype(np.float64)
    node_of, point_of = np.full(len(tree.radius), -1), np.full(len(tree.points), -1)
    best = np.full(len(tree.radius), np.inf)
    q, t = np.zeros(1, np.int64), np.zeros(1, np.int64)
    exact_q, exact_t = [], []
    leaf_q, leaf_t = tree.children == 0, over.children == 0
    while len(q):
        d = _apart(x[tree.centre[q]], c[over.centre[t]])
        np.minimum.at(best, q, d + tree.radius[q])  # a tree's centre is a centroid itself
        slack = 1e-9 * (d + tree.radius[q] + over.radius[t]) + 1e-6
        near = d - tree.radius[q] - over.radius[t] <= best[q] + slack
        q, t = q[near], t[near]
        if not len(q):
            break
        split = np.zeros(len(tree.radius), bool)  # nodes whose centroids are split before they are
        wider = ~leaf_t[t] & (leaf_q[q] | (over.radius[t] >= tree.radius[q]))
        split[q[wider]] = True
        down = split[q] & ~leaf_t[t]
        stay = split[q] & leaf_t[t]
        rest = ~split[q]
        alone = np.bincount(q, minlength=len(split)) == 1
        whole = rest & alone[q] & leaf_t[t] & (over.last[t] - over.first[t] == 1)
        node_of[q[whole]] = over.order[over.first[t[whole]]]
        at_leaf = rest & ~whole & leaf_q[q] & leaf_t[t]
        exact_q.append(q[at_leaf])
        exact_t.append(t[at_leaf])
        deeper = rest & ~whole & ~leaf_q[q]
        n_t, n_q = over.children[t[down]], tree.children[q[deeper]]
        kids = _spread(tree.child[q[deeper]], n_q)
        np.minimum.at(best, kids, np.repeat(best[q[deeper]], n_q))
        q, t = (
            np.concatenate([np.repeat(q[down], n_t), q[stay], kids]),
            np.concatenate([_spread(over.child[t[down]], n_t), t[stay], np.repeat(t[deeper], n_q)]),
        )
    made = _compare(tree, centroids, over, np.concatenate(exact_q or [q]), np.concatenate(exact_t or [t]), point_of)
    return node_of, point_of, made


def _compare(tree: Tree, centroids: np.ndarray, over: Tree, q: np.ndarray, t: np.ndarray, point_of: np.ndarray, most: int = 1 << 16) -> int:
    """Points of leaves q against all centroids of the leaves t beside them: the nearest, of equals the smaller number."""
    sort = np.argsort(q, kind="stable")
    q, t = q[sort], t[sort]
    n = over.last[t] - over.first[t]
    q, cent = np.repeat(q, n), over.order[_spread(over.first[t], n)]
    size = tree.last[q] - tree.first[q]
    nearest = np.full(len(tree.points), np.iinfo(np.int64).max)
    made, lo, ends = 0, 0, np.cumsum(size)
    while lo < len(q):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        p, k = _spread(tree.first[q[lo:hi]], size[lo:hi]), np.repeat(cent[lo:hi], size[lo:hi])
        for a in range(0, len(p), most):  # a leaf of equal points may be large
            d = squared(tree.points[p[a : a + most]], centroids[k[a : a + most]])
            rank = np.lexsort((k[a : a + most], d, p[a : a + most]))
            ps, ds, ks = p[a : a + most][rank], d[rank], k[a : a + most][rank]
            head = np.flatnonzero(np.r_[True, ps[1:] != ps[:-1]])
            ps, ds, ks = ps[head], ds[head], ks[head]
            better = (ds < nearest[ps]) | ((ds == nearest[ps]) & (ks < point_of[ps]))
            nearest[ps[better]], point_of[ps[better]] = ds[better], ks[better]
        made += len(p)
        lo = hi
    return made


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def _sums(tree: Tree) -> np.ndarray:
    """Sum of each node's points."""
    run = np.vstack([np.zeros((1, tree.points.shape[1]), np.int64), np.cumsum(tree.points, axis=0)])
    return run[tree.last] - run[tree.first]


_BLOCK = "ids array<{id}>, points array<long>, centre array<int>, radius array<double>, first array<int>, last array<int>, child array<int>, children array<int>, sums array<long>"


def _lists(parts: Sequence[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *(p.size for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([p.ravel() for p in parts]), kind))


def _trees(vectors: DataFrame, dims: int, block: int) -> DataFrame:
    """A row a tree over at most `block` vectors (id, v) of one task."""
    kind = vectors.schema["id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(parts: list[tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
            ids, x = pa.concat_arrays([i for i, _ in parts]), np.concatenate([v for _, v in parts])
            if len(x) and (x.max() > LARGEST or x.min() < -LARGEST):
                raise ValueError(f"a component above {LARGEST}: squared distances leave 64 bits")
            t = cover_tree(x)
            own = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(t.order)))
            ints = [_lists([v], pa.int32()) for v in (t.first, t.last, t.child, t.children)]
            return pa.RecordBatch.from_arrays([own, _lists([t.points], pa.int64()), _lists([t.centre], pa.int32()), _lists([t.radius], pa.float64()), *ints, _lists([_sums(t)], pa.int64())], names=names)

        held, n = [], 0
        for rb in batches:
            ids, x = rb.column(0), rb.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            lo = 0
            while lo < len(x):
                take = min(block - n, len(x) - lo)
                held.append((ids.slice(lo, take), x[lo : lo + take]))
                n, lo = n + take, lo + take
                if n == block:
                    yield row(held)
                    held, n = [], 0
        if n:
            yield row(held)

    names = [p.split()[0] for p in _BLOCK.split(", ")]
    return vectors.mapInArrow(build, _BLOCK.format(id=kind))


def _read(rb: pa.RecordBatch, i: int, dims: int) -> tuple[pa.Array, Tree, np.ndarray]:
    of = lambda name: rb.column(rb.schema.get_field_index(name))[i].values
    num = lambda name: of(name).to_numpy(zero_copy_only=False)
    whole = lambda name: num(name).astype(np.int64)
    points = num("points").reshape(-1, dims)
    return of("ids"), Tree(points, np.arange(len(points)), whole("centre"), num("radius"), whole("first"), whole("last"), whole("child"), whole("children")), num("sums").reshape(-1, dims)


def _round(trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every non-empty centroid replaced by the floor of its vectors' mean. One row a component, centroid and task is
    shuffled, one a component and centroid reaches the driver."""
    dims = centroids.shape[1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over, n, total = cover_tree(centroids, leaf=1), np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for rb in batches:
            for i in range(rb.num_rows):
                _, tree, sums = _read(rb, i, dims)
                node_of, point_of, _ = assign(tree, centroids, over)
                whole, single = np.flatnonzero(node_of >= 0), np.flatnonzero(point_of >= 0)
                np.add.at(n, node_of[whole], tree.last[whole] - tree.first[whole])
                np.add.at(total, node_of[whole], sums[whole])
                n += np.bincount(point_of[single], minlength=len(n))
                np.add.at(total, point_of[single], tree.points[single])
        met = np.flatnonzero(n)
        cluster, part = np.repeat(met, dims + 1), np.tile(np.arange(dims + 1), len(met))  # part 0 is the number of vectors
        each = np.column_stack([n[met], total[met]]).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(part, pa.int32()), pa.array(each, pa.int64())], names=["cluster", "part", "total"])

    parts = trees.mapInArrow(count, "cluster int, part int, total long").groupBy("cluster", "part").agg(F.sum("total").alias("total"))
    got = {(r["cluster"], r["part"]): r["total"] for r in parts.collect()}
    out = centroids.copy()
    for c in {c for c, _ in got}:
        out[c] = [got[c, j + 1] // got[c, 0] for j in range(dims)]
    return out


def _final(trees: DataFrame, centroids: np.ndarray, kind: str) -> DataFrame:
    dims = centroids.shape[1]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = cover_tree(centroids, leaf=1)
        for rb in batches:
            for i in range(rb.num_rows):
                ids, tree, _ = _read(rb, i, dims)
                node_of, of, _ = assign(tree, centroids, over)
                for v in np.flatnonzero(node_of >= 0):
                    of[tree.first[v] : tree.last[v]] = node_of[v]
                yield pa.RecordBatch.from_arrays([ids, pa.array(of, pa.int32()), pa.array(squared(tree.points, centroids[of]))], names=["id", "cluster", "distance"])

    return trees.mapInArrow(label, f"id {kind}, cluster int, distance long")


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid_sha256 of every vector with `dims` finite components.

    Components become floor(scale * x). The first centroids are the k vectors whose ids have the smallest SHA-256 of
    "seed:id"; of equal ids the smaller vector, a null id comes last. Fewer than k vectors are as many centroids, equal
    ones among them too. Ties go to the smaller number, an empty centroid stays. Vectors of another length, with a null,
    NaN or infinite component, and null vectors have no row; repeated rows have one each. Only id_col and vector_col are
    read, so other columns may have any name. A component beyond 2 ** 27 after scaling raises an error, as its distances have no
    64-bit value.
    """
    v = F.col(vector_col)
    fine = (F.size(v) == dims) & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).alias("id"), whole.alias("v"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = rows.orderBy(order.asc_nulls_last(), "v").limit(k).collect()  # k vectors
    kind = rows.schema["id"].dataType.simpleString()
    named = [F.col("id").alias(id_col), "cluster", "distance"]
    if not start:
        return rows.select("id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256")).select(*named, "cluster_inertia", "inertia", "centroid_sha256")
    centroids = np.array([r["v"] for r in start], np.int64)
    trees = materialise(_trees(rows, dims, block), "trees")
    with rows_a_batch(vectors.sparkSession, 4):
        for _ in range(rounds):
            new = _round(trees, centroids)
            if np.array_equal(new, centroids):
                break  # later rounds change nothing
            centroids = new
        found = materialise(_final(trees, centroids, kind), "clusters")
    discard(trees)
    each = {r["cluster"]: int(r["total"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    total = sum(each.values())
    if total > np.iinfo(np.int64).max:
        raise ValueError("the inertia leaves 64 bits")
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    known = F.create_map(*[F.lit(x) for c, n in sorted(each.items()) for x in (c, n)])
    return found.select(*named, known[F.col("cluster")].alias("cluster_inertia"), F.lit(total).cast("long").alias("inertia"), F.array(*map(F.lit, sha))[F.col("cluster")].alias("centroid_sha256"))
