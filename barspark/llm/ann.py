"""Approximate nearest neighbours by low-dimensional stable projections and a kd-tree (cosine).

Unit vectors are projected to ``DIMS`` Gaussian directions.  For two vectors at distance d the squared
projected distance is d^2 times a chi-square variable with ``DIMS`` degrees of freedom, so a neighbour
within d has a projected distance below d * sqrt(chi2_inv(CONFIDENCE)) with that confidence.  A query
walks its projected neighbours outwards in rings, verifies them on the original vectors, and stops
when the next one lies beyond that radius for the k-th best distance found so far: the chi-square stopping
test.  So each true neighbour is missed with a chance of 1 - ``CONFIDENCE`` at most.

Spread over a cluster, the top of the kd-tree deals the points to cells (splits fitted on a bounded
sample), large cells further to blocks by hash, and a group (cell, block) is a small kd-tree of its
own.  A query visits its home group first, then the others in the order of their boxes' distance, in rounds
that grow fourfold; between rounds its best rows are merged, and it goes on only while the next box passes
the test for the bound they give.  A group that many queries visit is read by several tasks, each with
a share of them.  Equal vectors are one point that carries the smallest ids: a result can't
need more of them than its length.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barspark.session import materialize

DIMS, SEED = 24, 71
CONFIDENCE = 0.9
#: Points of a group (one kd-tree in one task) and of a leaf.
GROUP_ROWS, LEAF_ROWS = 8192, 64
#: Largest number of the top tree's cells, and sample points that fit each of them.
MAX_CELLS, CELL_SAMPLE = 8192, 20
#: Projected neighbours of the first ring; each ring is twice as wide.
RING = 64
#: Groups of the first round after home, growth of a round, and its largest size.
ROUND_GROUPS, ROUND_GROWTH, MAX_ROUND = 3, 4, 4096
#: Queries that one task answers on one group.
QUERY_ROWS = 32_768
#: Rounding allowance on squared distances of unit vectors.
SLACK = 1e-9


def chi2_quantile(p: float, degrees: int) -> float:
    """Value below which a chi-square variable of an even number of degrees falls with probability ``p``."""
    if degrees % 2:
        raise ValueError("degrees must be even")

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for j in range(1, degrees // 2):
            term *= x / 2 / j
            total += term
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return high


def unit(v: np.ndarray) -> np.ndarray:
    """Rows at length 1 (scaled by their largest component first, so tiny vectors don't vanish)."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, in double precision on the vectors as they are."""
    return (b * a).sum(axis=1) / (math.sqrt(float((a * a).sum())) * np.sqrt((b * b).sum(axis=1)))


@dataclass
class TopTree:
    """Projection and the median splits of the projected space down to ``2**depth`` cells."""

    dim: int
    depth: int
    axis: np.ndarray  # of the inner nodes, heap order
    cut: np.ndarray
    low: np.ndarray  # of the cells' boxes
    high: np.ndarray

    def project(self, v: np.ndarray) -> np.ndarray:
        return unit(v) @ np.random.default_rng(SEED).standard_normal((self.dim, DIMS))

    def cell(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (p[np.arange(len(p)), self.axis[node]] > self.cut[node])
        return node - ((1 << self.depth) - 1)

    @staticmethod
    def fit(points: np.ndarray, dim: int, cells: int) -> TopTree:
        """Splits at the medians of projected sample points."""
        depth = max(0, math.ceil(math.log2(max(1, cells))))
        inner = (1 << depth) - 1
        tree = TopTree(dim, depth, np.zeros(inner, np.int64), np.zeros(inner), np.full((1 << depth, DIMS), -np.inf), np.full((1 << depth, DIMS), np.inf))

        def split(node: int, rows: np.ndarray, low: np.ndarray, high: np.ndarray, left: int) -> None:
            if not left:
                tree.low[node - inner], tree.high[node - inner] = low, high
                return
            own = points[rows]
            axis = int(own.std(axis=0).argmax()) if len(rows) else 0
            cut = float(np.median(own[:, axis])) if len(rows) else 0.0
            tree.axis[node], tree.cut[node] = axis, cut
            up, down = high.copy(), low.copy()
            up[axis] = down[axis] = cut
            side = own[:, axis] > cut if len(rows) else np.zeros(0, bool)
            split(2 * node + 1, rows[~side], low, up, left - 1)
            split(2 * node + 2, rows[side], down, high, left - 1)

        split(0, np.arange(len(points)), np.full(DIMS, -np.inf), np.full(DIMS, np.inf), depth)
        return tree


def box_distance(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to each box."""
    gap = np.maximum(np.maximum(low - p, p - high), 0)
    return (gap * gap).sum(axis=1)


class LocalTree:
    """kd-tree over a group's projected points; ``search`` walks them outwards, ring by ring."""

    def __init__(self, vectors: np.ndarray, points: np.ndarray, ids: list[list[int]]):
        leaves = [np.arange(len(points))]
        while max(map(len, leaves)) > LEAF_ROWS:
            cut: list[np.ndarray] = []
            for rows in leaves:
                if len(rows) <= LEAF_ROWS:
                    cut.append(rows)
                    continue
                axis = int(np.ptp(points[rows], axis=0).argmax())
                order = np.argsort(points[rows, axis], kind="stable")
                cut += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
            leaves = cut
        # Points lie in leaf order, so a leaf is a run of rows.
        order = np.concatenate(leaves)
        self.vectors, self.units, self.points = vectors[order], unit(vectors[order]), points[order]
        self.squares = (self.points * self.points).sum(axis=1)
        self.ids = [ids[r] for r in order.tolist()]
        self.sizes = np.array([len(r) for r in leaves])
        self.low = np.array([points[r].min(axis=0) for r in leaves])
        self.high = np.array([points[r].max(axis=0) for r in leaves])

    def search(self, v: np.ndarray, p: np.ndarray, k: int, bound: float, factor: float) -> tuple[list[tuple[float, int]], float, int]:
        """The best ``k`` (score, id) rows not worse than ``bound`` (squared unit distance), the new bound, and how
        many points were verified."""
        rows = np.flatnonzero(np.repeat(box_distance(p, self.low, self.high) <= bound * factor + SLACK, self.sizes))
        near = self.squares[rows] - 2 * (self.points[rows] @ p) + p @ p
        own = unit(v[None, :])[0]
        best: list[tuple[float, int]] = []
        width, seen = RING, 0
        while rows.size:
            # The stopping test: no projected neighbour further out is likely to be nearer than the bound.
            left = near <= bound * factor + SLACK
            rows, near = rows[left], near[left]
            ring, rest = np.arange(rows.size), np.zeros(0, np.int64)
            if rows.size > width:
                order = np.argpartition(near, width - 1)
                ring, rest = order[:width], order[width:]
            told = rows[ring]
            seen += told.size
            told = told[2 - 2 * (self.units[told] @ own) <= bound + SLACK]
            for r, score in zip(told.tolist(), cosines(v, self.vectors[told]).tolist()):
                best += [(score, i) for i in self.ids[r]]
            if len(best) >= k:
                best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
                bound = min(bound, max(0.0, 2 - 2 * best[-1][0]))
            rows, near = rows[rest], near[rest]
            width *= 2
        return sorted(best, key=lambda x: (-x[0], x[1]))[:k], bound, seen


_FIELDS = "grp bigint, kind int, rep bigint, ids array<bigint>, v array<double>, bound double"
_ANSWER = "rep bigint, bound double, verified bigint, best array<struct<far:double,vec_id:bigint>>"


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Arrays of at most ``dim`` numbers as rows, shorter ones padded with zeros."""
    sizes = np.diff(np.asarray(col.offsets))
    flat = np.asarray(col.flatten(), np.float64)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _projected(dim: int):
    """Vectors as their few projected coordinates (what the sample brings to the driver)."""
    tree = TopTree.fit(np.zeros((0, DIMS)), dim, 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = tree.project(_matrix(batch.column(0), dim))
                yield pa.RecordBatch.from_arrays([pa.array(list(p), pa.list_(pa.float64()))], names=["p"])

    return run


def _assign(tree: TopTree, blocks: int):
    """Points with their group; queries (kind 1) with their home group."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = tree.cell(tree.project(_matrix(batch.column(4), tree.dim)))
                block = np.asarray(batch.column(0)) % blocks
                yield pa.RecordBatch.from_arrays([pa.array(cell * blocks + block, pa.int64()), *batch.columns[1:]], names=batch.schema.names)

    return run


def _reach(tree: TopTree, blocks: int, factor: float, start: int, stop: int):
    """A bounded query once for each of its ``start``-th to ``stop``-th nearest groups (home left out) whose box passes the test."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = tree.project(_matrix(batch.column(4), tree.dim))
            home, bound = np.asarray(batch.column(0)), np.asarray(batch.column(5))
            rows, groups = [], []
            for r in range(batch.num_rows):
                away = box_distance(points[r], tree.low, tree.high)
                # One more place than asked for, as home is among them.
                cells = np.argsort(away, kind="stable")[: stop // blocks + 2]
                found = (cells[:, None] * blocks + np.arange(blocks)).ravel()
                found = found[found != home[r]][start:stop]
                found = found[away[found // blocks] <= bound[r] * factor + SLACK]
                rows.append(np.full(found.size, r))
                groups.append(found)
            take = batch.take(pa.array(np.concatenate(rows), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(groups), pa.int64()), *take.columns[1:]], names=batch.schema.names)

    return run


def _search(tree: TopTree, k: int, factor: float):
    """Rows sorted by (group, salt, kind): a group's points, then its queries, which are answered one by one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ids, local = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column(4), tree.dim)
            points = tree.project(vectors)
            cols = [batch.column(i).to_pylist() for i in (0, 6, 1, 2, 3, 5)]
            out: list[list] = [[], [], [], []]
            for r, (group, salt, kind, rep, own, bound) in enumerate(zip(*cols)):
                if (group, salt) != now:
                    now, held, ids, local = (group, salt), [], [], None
                if kind == 0:
                    held.append((vectors[r].copy(), points[r].copy()))
                    ids.append(own)
                    continue
                if local is None and held:
                    local, held = LocalTree(np.array([h[0] for h in held]), np.array([h[1] for h in held]), ids), []
                best, limit, seen = local.search(vectors[r], points[r], k, bound, factor) if local else ([], bound, 0)
                for col, v in zip(out, (rep, limit, seen, [{"far": -b[0], "vec_id": b[1]} for b in best])):
                    col.append(v)
            kinds = [pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.struct([("far", pa.float64()), ("vec_id", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["rep", "bound", "verified", "best"])

    return run


def _answered(indexed: DataFrame, asked: DataFrame, tree: TopTree, k: int, factor: float, query_rows: int) -> DataFrame:
    """Answers of the groups that are asked; a group with many queries is copied once for every ``query_rows`` of them."""
    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = asked.groupBy("grp").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("salts"))
    points = indexed.join(salts, "grp").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    those = asked.join(salts, "grp").withColumn("salt", F.pmod(F.xxhash64("rep"), F.col("salts")).cast("int")).drop("salts")
    both = points.unionByName(those).repartition(parts, "grp", "salt").sortWithinPartitions("grp", "salt", "kind")
    return both.mapInArrow(_search(tree, k, factor), _ANSWER)


def _merged(answers: DataFrame, k: int) -> DataFrame:
    """One row a query: its best ``k`` rows, the bound they give, and how many points were verified."""
    best = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("best")))), 1, k)
    rows = answers.groupBy("rep").agg(F.min("bound").alias("bound"), F.sum("verified").alias("verified"), best.alias("best"))
    last = F.greatest(F.lit(0.0), 2 + 2 * F.try_element_at("best", F.lit(k))["far"])
    return rows.withColumn("bound", F.when(F.size("best") >= k, F.least("bound", last)).otherwise(F.col("bound")))


def nearest(
    vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", confidence: float = CONFIDENCE, group_rows: int = GROUP_ROWS,
    max_cells: int = MAX_CELLS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score, verified``: the ``k`` nearest by cosine of every row whose id satisfies
    ``is_query`` (a Column of the id), among all rows but itself; ties to the smaller id.  ``verified`` counts the
    distinct vectors that were compared with the query's on the original components.

    Vectors that are null, empty or zero, or hold a null or non-finite component, and rows with a null
    id, take no part; shorter vectors count as padded with zeros.  Fewer candidates than ``k`` give them
    all.  Rows repeated with an id and vector count once; one id with several vectors stands for
    several points, its result lists an id once a point.  An empty table gives no rows.
    """
    usable = F.col("v").isNotNull() & (F.size("v") > 0) & F.col("id").isNotNull()
    usable &= F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(usable)
    # Equal vectors become one point with its smallest ids; the group limit runs before the shuffle.
    first = rows.withColumn("rn", F.dense_rank().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("rn") <= k + 1)
    grouped = first.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    # Numbered in the written table, so every later read sees the same numbers; draws and blocks go by the vector.
    points = materialize(grouped.select(F.monotonically_increasing_id().alias("rep"), "ids", "v"), "points")
    n, dim = points.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    cells = min(max_cells, max(1, -(-n // group_rows)))
    # About CELL_SAMPLE points a cell, by their hash: about that times max_cells rows of DIMS numbers.
    share = min(1 << 30, math.ceil((1 << 30) * CELL_SAMPLE * cells / n)) if n else 0
    drawn = points.filter(F.pmod(F.xxhash64(F.lit(SEED), "v"), F.lit(1 << 30)) < share).orderBy(F.xxhash64("v")).select("v")
    sample = [r.p for r in drawn.mapInArrow(_projected(dim), "p array<double>").collect()] if cells > 1 else []
    tree = TopTree.fit(np.array(sample).reshape(-1, DIMS), dim, cells)
    blocks = max(1, -(-n // ((1 << tree.depth) * group_rows)))
    factor = chi2_quantile(confidence, DIMS)

    zero = F.lit(None).cast("double")
    # A query's home is the group of its own vector.
    indexed = points.select(F.pmod(F.xxhash64("v"), F.lit(blocks)).alias("grp"), F.lit(0).alias("kind"), "rep", "ids", "v", zero.alias("bound"))
    indexed = materialize(indexed.mapInArrow(_assign(tree, blocks), _FIELDS), "indexed")
    wanted = rows.filter(is_query(F.col("id"))).distinct()
    named = materialize(wanted.withColumnRenamed("id", "query_id").join(indexed.select("grp", "rep", "v"), "v"), "queries")
    queries = named.select("grp", F.lit(1).alias("kind"), "rep", F.lit(None).cast("array<bigint>").alias("ids"), "v").dropDuplicates(["rep", "v"])

    best = materialize(_merged(_answered(indexed, queries.withColumn("bound", F.lit(8.0)), tree, k + 1, factor, query_rows), k + 1), "home")
    groups, start, size = (1 << tree.depth) * blocks, 0, ROUND_GROUPS
    while start < groups - 1:
        bounded = queries.join(best.select("rep", "bound"), "rep").select("grp", "kind", "rep", "ids", "v", "bound")
        asked = materialize(bounded.mapInArrow(_reach(tree, blocks, factor, start, start + size), _FIELDS), "asked")
        if asked.isEmpty():
            break  # boxes further out fail the test for every query
        best = materialize(_merged(best.unionByName(_answered(indexed, asked, tree, k + 1, factor, query_rows)), k + 1), "best")
        start, size = start + size, min(MAX_ROUND, size * ROUND_GROWTH)
    found = named.select("query_id", "rep").join(best, "rep").select("query_id", "rep", "verified", F.explode("best").alias("b"))
    out = found.select("query_id", "rep", F.col("b.vec_id").alias("vec_id"), (-F.col("b.far")).alias("score"), "verified").filter("vec_id <> query_id")
    rank = Window.partitionBy("query_id", "rep").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "verified")
