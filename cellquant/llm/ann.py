"""Nearest neighbours by largest inner product: stable projections to few dimensions, kd-trees, a chi-square stopping test.

Inner products become distances by one more component, sqrt(M^2 - |x|^2) with M the largest norm (0 for queries). A Gaussian
projection to ``DIMS`` dimensions is cut by a kd-tree twice: its upper part, fitted on a bounded sample, deals the
candidates to blocks, each to one; its lower part is built inside a block. A query takes blocks, and leaves inside them, in
order of projected distance and verifies their vectors in full; it leaves out what has a projected distance r where its
k-th best true distance d satisfies P(chi-square(DIMS) <= r^2 / d^2) > ``confidence``: what is there is then unlikely
to be nearer. The nearest blocks come first; their k-th distances tell which other blocks a query must still visit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellquant.llm.common import materialize

DIMS, LEAF, STEP = 8, 64, 8
#: queries times blocks that are compared at a time, some 50 bytes each
PAIRS = 1 << 20


def chi2_cdf(x: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """P(chi-square <= x) for an even number of degrees of freedom."""
    half, term, total = x / 2, np.ones_like(x), np.ones_like(x)
    for i in range(1, dims // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


@dataclass(frozen=True)
class Space:
    """How vectors of one length are projected, and the upper tree: ``axis``, ``cut`` and the two ``children`` of each node (a
    child below zero is block -1 - child). ``top`` is the largest norm after scaling by ``scale``, a power of two."""

    axes: np.ndarray
    top: float
    scale: float
    axis: np.ndarray
    cut: np.ndarray
    children: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.top**2 - (x**2).sum(1), 0))
        return np.column_stack((x, lift)) @ self.axes

    def block_of(self, p: np.ndarray) -> np.ndarray:
        at = np.zeros(len(p), np.int64) if len(self.axis) else np.full(len(p), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            at[inner] = self.children[node, (p[inner, self.axis[node]] > self.cut[node]).astype(int)]
        return -1 - at


def fit_space(sample: np.ndarray, axes: np.ndarray, top: float, scale: float, rows: int, block_rows: int) -> Space:
    """Cut the projected sample at medians of the widest axis until blocks hold ``block_rows`` of all ``rows`` (16 of the
    sample at least)."""
    least = max(16.0, block_rows * len(sample) / max(rows, 1))
    axis, cut, children, blocks = [], [], [], 0
    todo = [(np.arange(len(sample)), -1, 0)]
    while todo:
        at, parent, side = todo.pop()
        wide = int(np.argmax(np.ptp(sample[at], axis=0))) if len(at) > least else 0
        middle = np.median(sample[at, wide]) if len(at) > least else 0.0
        right = sample[at, wide] > middle if len(at) > least else np.zeros(0, bool)
        if right.any():
            if parent >= 0:
                children[parent][side] = len(axis)
            todo += [(at[~right], len(axis), 0), (at[right], len(axis), 1)]
            axis.append(wide)
            cut.append(middle)
            children.append([0, 0])
        else:
            if parent >= 0:
                children[parent][side] = -1 - blocks
            blocks += 1
    return Space(axes, top, scale, np.array(axis, int), np.array(cut), np.array(children, int).reshape(-1, 2))


class ProjectedTree:
    """kd-tree over a block's projected vectors: leaves of up to ``LEAF`` rows with their bounding boxes."""

    def __init__(self, x: np.ndarray, space: Space):
        p = space.project(x)
        self.axes = space.axes
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(x))]
        while todo:
            at = todo.pop()
            if len(at) <= LEAF:
                self.leaves.append(at)
                continue
            axis = int(np.argmax(np.ptp(p[at], axis=0)))
            half = len(at) // 2
            order = np.argpartition(p[at, axis], half)
            todo += [at[order[:half]], at[order[half:]]]
        self.low = np.array([p[at].min(0) for at in self.leaves])
        self.high = np.array([p[at].max(0) for at in self.leaves])
        self.x, self.top = x, space.top

    def leaf_distances(self, q: np.ndarray) -> np.ndarray:
        """Squared projected distance from each query to each leaf's box."""
        return box_distances(q @ self.axes[:-1], self.low, self.high)


def box_distances(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from each point to each box, summed axis by axis: nothing larger than points times boxes is held."""
    out = np.zeros((len(p), len(low)))
    for i in range(p.shape[1]):
        gap = np.maximum(low[:, i] - p[:, i, None], p[:, i, None] - high[:, i])
        np.maximum(gap, 0, out=gap)
        out += gap * gap
    return out


def search_block(q: np.ndarray, q_ids: np.ndarray, tree: ProjectedTree, ids: np.ndarray, k: int, confidence: float, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query place, candidate place) of each query's k best that its search verified, ties to smaller ids. ``known``: the
    k-th best score that each query has from elsewhere (-inf: none)."""
    near = tree.leaf_distances(q)
    order = np.argsort(near, axis=1)
    left = np.take_along_axis(near, order, axis=1)
    n_leaves = len(tree.leaves)
    best = np.full((len(q), k), -np.inf)
    where = np.full((len(q), k), -1)
    norm = (q**2).sum(1) + tree.top**2

    def done(at: np.ndarray, next_leaf: np.ndarray) -> np.ndarray:
        kth = np.maximum(best[at].min(1), known[at])
        d2 = np.maximum(norm[at] - 2 * kth, 1e-12)
        return np.isfinite(d2) & (chi2_cdf(next_leaf / d2) > confidence)

    active = np.flatnonzero(~done(np.arange(len(q)), left[:, 0]))
    for lo in range(0, n_leaves, STEP):
        if not len(active):
            break
        turn = order[active, lo : lo + STEP]
        score = np.full((len(active), turn.shape[1] * LEAF), -np.inf)
        place = np.full(score.shape, -1)
        for leaf in np.unique(turn):
            row, slot = np.nonzero(turn == leaf)
            at = tree.leaves[leaf]
            cols = slot[:, None] * LEAF + np.arange(len(at))
            score[row[:, None], cols] = q[active[row]] @ tree.x[at].T
            place[row[:, None], cols] = at
        score[(place >= 0) & (ids[place] == q_ids[active][:, None])] = -np.inf
        score, place = np.hstack((best[active], score)), np.hstack((where[active], place))
        picked = np.argpartition(-score, k - 1, axis=1)[:, :k]
        kth = np.take_along_axis(score, picked, axis=1).min(1)
        tied = (score >= kth[:, None] - 1e-9).sum(1) > k
        for r in np.flatnonzero(tied & np.isfinite(kth)):  # equal scores at the edge: exact ones, smaller ids first
            at = np.flatnonzero(score[r] >= kth[r] - 1e-9)
            exact = (tree.x[place[r, at]] * q[active[r]]).sum(1)
            picked[r] = at[np.lexsort((ids[place[r, at]], -exact))[:k]]
        best[active], where[active] = np.take_along_axis(score, picked, axis=1), np.take_along_axis(place, picked, axis=1)
        if lo + STEP < n_leaves:
            active = active[~done(active, left[active, lo + STEP])]
    row, col = np.nonzero(np.isfinite(best))
    return row, where[row, col]


def _vectors(x: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    return np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))


def _spaces(rows: DataFrame, block_rows: int, sample_rows: int, seed: int = 11) -> dict[int, Space]:
    """The space of each vector length. A sample of about ``sample_rows`` projected vectors of each, picked by hash, comes to
    the driver; the upper tree only balances the blocks by it, and every row is dealt."""
    largest = F.array_max(F.transform("x", lambda v: F.abs(v)))
    log_norm = F.log2(largest) + F.log2(F.aggregate("x", F.lit(0.0), lambda a, v: a + (v / largest) * (v / largest))) / 2
    stats = {r["dim"]: r for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(log_norm).alias("top")).collect()}
    if not stats:
        return {}
    plain: dict[int, Space] = {}
    for dim, s in stats.items():
        scale = 1.0 if abs(s["top"]) < 400 else 2.0 ** -math.ceil(s["top"])  # only where squares would overflow or vanish
        none = np.zeros(0)
        plain[dim] = Space(np.random.default_rng(seed).standard_normal((dim + 1, DIMS)), 2.0 ** s["top"] * scale * (1 + 1e-9) if scale == 1 else 2.0 ** (s["top"] - math.ceil(s["top"])) * (1 + 1e-9), scale, none.astype(int), none, none)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                space = plain[len(x)]
                yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([space.project(np.array([x]) * space.scale)[0].tolist()], pa.list_(pa.float64()))], ["dim", "p"])

    share = F.create_map(*(F.lit(v) for d, s in stats.items() for v in (d, min(1.0, sample_rows / s["n"]))))
    picked = rows.where(F.pmod(F.xxhash64("vec_id", "x"), F.lit(1 << 20)) < share[F.col("dim")] * (1 << 20)).select("x")
    found: dict[int, list[list[float]]] = {d: [] for d in stats}
    for r in picked.mapInArrow(project, "dim int, p array<double>").collect():
        found[r["dim"]].append(r["p"])
    return {d: fit_space(np.array(found[d]).reshape(-1, DIMS), s.axes, s.top, s.scale, stats[d]["n"], block_rows) for d, s in plain.items()}


def nearest(embeddings: DataFrame, *, every: int = 20, k: int = 20, confidence: float = 0.98, block_rows: int = 8192, query_rows: int = 2048, sample_rows: int = 100_000) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose vec_id is divisible by ``every``, its ``k`` nearest found.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows with a null
    vec_id; only vectors of the query's own dimension are candidates. Rows with the query's own vec_id are never its
    neighbours. Of repeated query rows the least vector asks; repeated candidates all stay. Ties go to the smaller vec_id. An
    empty table gives an empty result. Inner products beyond the largest double are infinite.

    A block of more than ``block_rows`` rows (vectors that no cut parts) is dealt on to parts by hash, and the queries that
    visit a block come ``query_rows`` at a time, so no task holds more than both.
    """
    e = F.col("embedding")
    sound = F.col("vec_id").isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = embeddings.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("x")).withColumn("dim", F.size("x"))
    kind = "query_id long, vec_id long, score double"
    spaces = _spaces(rows, block_rows, sample_rows)
    if not spaces:
        return embeddings.sparkSession.createDataFrame([], kind).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(2).to_numpy()
            for dim in np.unique(dims):
                own = b.filter(pa.array(dims == dim))
                space = spaces[int(dim)]
                p = space.project(_vectors(own.column(1), dim) * space.scale)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(space.block_of(p)), *(pa.array(p[:, i]) for i in range(DIMS))], ["vec_id", "x", "dim", "block", *(f"p{i}" for i in range(DIMS))])

    projected = ", ".join(f"p{i} double" for i in range(DIMS))
    dealt = materialize(rows.mapInArrow(deal, f"vec_id long, x array<double>, dim int, block long, {projected}"), "vector-blocks")
    ends = [f(F.col(f"p{i}")).alias(f"{n}{i}") for f, n in ((F.min, "low"), (F.max, "high")) for i in range(DIMS)]
    sizes = dealt.groupBy("dim", "block").agg(F.count(F.lit(1)).alias("n"), *ends).orderBy("dim", "block").collect()  # a block holds 16 of the sample
    boxes = {d: tuple(np.array([[r[f"{n}{i}"] for i in range(DIMS)] for r in sizes if r["dim"] == d]) for n in ("low", "high")) for d in spaces}
    counts = {d: np.array([r["n"] for r in sizes if r["dim"] == d]) for d in spaces}
    names = {d: np.array([r["block"] for r in sizes if r["dim"] == d]) for d in spaces}

    def visits(first: bool):
        """Queries with a row for each block: the nearest ones until they hold four times ``k`` rows, or all others that the
        test does not leave out."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            step = max(1, min(1024, PAIRS // max(map(len, names.values()))))
            for b in batches:
                for lo in range(0, b.num_rows, step):
                    part = b.slice(lo, step)
                    dims = part.column("dim").to_numpy()
                    for dim in np.unique(dims):
                        own, space = part.filter(pa.array(dims == dim)), spaces[int(dim)]
                        q = _vectors(own.column("x"), dim) * space.scale
                        far = box_distances(q @ space.axes[:-1], *boxes[int(dim)])
                        order = np.argsort(far, axis=1, kind="stable")
                        held = np.cumsum(counts[int(dim)][order], axis=1) - counts[int(dim)][order]
                        go = np.zeros(far.shape, bool)
                        np.put_along_axis(go, order, held < 4 * k + 1, axis=1)
                        if not first:
                            d2 = np.maximum((q**2).sum(1) + space.top**2 - 2 * own.column("known").to_numpy(), 1e-12)
                            go = ~go & ~(np.isfinite(d2)[:, None] & (chi2_cdf(far / d2[:, None]) > confidence))
                        row, at = np.nonzero(go)
                        turn = own.take(pa.array(row))
                        yield pa.RecordBatch.from_arrays([*(turn.column(c) for c in ("query_id", "x", "dim", "known")), pa.array(names[int(dim)][at])], ["query_id", "x", "dim", "known", "block"])

        return run

    def search(q: pa.Table, c: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
        if q.num_rows and c.num_rows:
            dim = c["dim"][0].as_py()
            space = spaces[dim]
            qx, cx = _vectors(q["x"], dim), _vectors(c["x"], dim)
            q_ids, ids, known = q["query_id"].to_numpy(), c["vec_id"].to_numpy(), q["known"].to_numpy()
            tree = ProjectedTree(cx * space.scale, space)
            found = [search_block(qx[lo : lo + 512] * space.scale, q_ids[lo : lo + 512], tree, ids, k, confidence, known[lo : lo + 512]) for lo in range(0, len(qx), 512)]
            row = np.concatenate([f[0] + 512 * i for i, f in enumerate(found)])
            at = np.concatenate([f[1] for f in found])
            with np.errstate(over="ignore", invalid="ignore"):
                out = [q_ids[row], ids[at], (cx[at] * qx[row]).sum(1), (tree.x[at] * (qx[row] * space.scale)).sum(1)]
        return pa.table(out, names=["query_id", "vec_id", "score", "scaled"])

    def searched(asked: DataFrame, first: bool, name: str) -> DataFrame:
        wanted = materialize(asked.mapInArrow(visits(first), "query_id long, x array<double>, dim int, known double, block long"), f"{name}-visits")
        blocks = dealt.groupBy("dim", "block").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"))
        plan = wanted.groupBy("dim", "block").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("turns")).join(blocks, ["dim", "block"])
        plan = F.broadcast(plan)  # as many rows as there are blocks
        queries = wanted.join(plan, ["dim", "block"]).withColumn("turn", F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        rows = dealt.select("vec_id", "x", "dim", "block").join(plan, ["dim", "block"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "x"), F.col("parts")).cast("int"))
        rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        keys, cols = ["dim", "block", "part", "turn"], ["query_id", "x", "known"]
        pairs = queries.select(*keys, *cols).groupBy(*keys).cogroup(rows.select(*keys, "vec_id", "x").groupBy(*keys)).applyInArrow(search, f"{kind}, scaled double")
        best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("scaled"), "vec_id"))
        return materialize(pairs.withColumn("rank", best).where(F.col("rank") <= k), f"{name}-found")

    asked = dealt.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min_by("dim", "x").alias("dim"), F.min("x").alias("x"))
    asked = materialize(asked, "queries")
    near = searched(asked.withColumn("known", F.lit(float("-inf"))), True, "near")
    kth = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.min("scaled")).alias("known"))
    far = searched(asked.join(kth, "query_id", "left").select("query_id", "x", "dim", F.coalesce("known", F.lit(float("-inf"))).alias("known")), False, "far")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("scaled"), "vec_id"))
    return near.unionByName(far).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
