"""Compression of vectors to codes of a product codebook; entries are found through a GNAT.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts; each part position has a codebook.
A part's nearest entry is searched in a geometric near-neighbour access tree over the codebook: a node keeps
some entries as split points and deals the others to the nearest of them, with the least and the greatest distance
from every split point to the entries of every child.  A query measures its distance d to a node's split
points; a child whose range [lo, hi] from any of them lies strictly outside [d - r, d + r] (r: the best distance
so far) can't hold a better or equal entry and falls away as a whole subtree.  Ranges are rounded outwards and d and r
are widened, so rounding never drops an entry; the entries met are compared by their exact integer squared
distances, ties to the lower index.

Queries of a batch go down the tree together as numpy arrays.  Codebooks are small (parts x entries) and travel
with the tasks; one round of learning is one pass over the vectors that puts out a sum per part and entry and
task, combined by a grouped aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.session import materialize

#: Split points of a node, and entries that a leaf holds at most.
DEGREE, LEAF = 8, 8
#: Relative widening of distances: far above the rounding of a square root, far below a difference that matters.
MARGIN = 1e-12
#: Vectors handled at once inside a task.
BATCH_ROWS = 4096
#: Labels with more than this share of the rows are joined through a broadcast: there are at most 1 / share of them.
HOT_SHARE = 1e-4
FAR = np.iinfo(np.int64).max


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances [len(a), len(b)] of integer rows."""
    out = np.zeros((len(a), len(b)), np.int64)
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        out += d * d
    return out


@dataclass
class Node:
    ids: np.ndarray
    lo: np.ndarray | None = None
    hi: np.ndarray | None = None
    children: list["Node | None"] = field(default_factory=list)


class Gnat:
    """Nearest entry of integer queries; of equal entries only the one with the lowest index is kept, as it wins."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.entries, self.degree, self.leaf = entries, degree, leaf
        first = np.unique(entries, axis=0, return_index=True)[1] if entries.size else np.arange(min(1, len(entries)))
        self.visited = 0
        self.root = self._build(np.sort(first))

    def _build(self, ids: np.ndarray) -> Node:
        if len(ids) <= self.leaf:
            return Node(ids)
        points = self.entries[ids]
        # split points far apart from each other: each next one is the farthest from those chosen
        chosen, near = [0], squares(points, points[:1])[:, 0]
        while len(chosen) < min(self.degree, len(ids)):
            chosen.append(int(near.argmax()))
            near = np.minimum(near, squares(points, points[chosen[-1:]])[:, 0])
        splits = np.sort(np.array(chosen))
        d2 = squares(points, points[splits])
        home = d2.argmin(axis=1)
        d = np.sqrt(d2.astype(np.float64))
        m = len(splits)
        node = Node(ids[splits], np.full((m, m), np.inf), np.full((m, m), -np.inf))
        rest = np.ones(len(ids), bool)
        rest[splits] = False
        for j in range(m):
            own = rest & (home == j)
            node.children.append(self._build(ids[own]) if own.any() else None)
            if own.any():
                node.lo[:, j] = d[own].min(axis=0) * (1 - MARGIN)
                node.hi[:, j] = d[own].max(axis=0) * (1 + MARGIN)
        return node

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest entry, squared distance) of every row."""
        best, index = np.full(len(queries), FAR), np.full(len(queries), len(self.entries), np.int64)
        if len(queries) and len(self.root.ids):
            self._visit(self.root, queries, np.arange(len(queries)), best, index)
        return index, best

    def _visit(self, node: Node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        d2 = squares(queries[rows], self.entries[node.ids])
        self.visited += d2.size
        at = d2.argmin(axis=1)  # ids ascend: of equal distances the lowest index comes first
        found, who = d2[np.arange(len(rows)), at], node.ids[at]
        now = best[rows]
        better = (found < now) | ((found == now) & (who < index[rows]))
        best[rows[better]], index[rows[better]] = found[better], who[better]
        if not any(node.children):
            return
        d = np.sqrt(d2.astype(np.float64))
        # the child of the nearest split point first: it shortens the radius for the others
        for j, child in enumerate(node.children):
            if child is not None and (own := at == j).any():
                self._descend(child, node, j, d[own], queries, rows[own], best, index)
        for j, child in enumerate(node.children):
            if child is not None and (own := at != j).any():
                self._descend(child, node, j, d[own], queries, rows[own], best, index)

    def _descend(self, child: Node, node: Node, j: int, d: np.ndarray, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        r = np.sqrt(best[rows].astype(np.float64))[:, None] * (1 + MARGIN)
        gone = (d * (1 - MARGIN) - r > node.hi[:, j]) | (d * (1 + MARGIN) + r < node.lo[:, j])
        left = rows[~gone.any(axis=1)]
        if len(left):
            self._visit(child, queries, left, best, index)


def _whole(vec: Column) -> Column:
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``id, label, v`` of the rows whose vector and components are neither null nor infinite nor NaN."""
    vec = F.col(vec_col).cast("array<double>")
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"), vec.alias("v")).where(_whole(F.col("v")))


def _integers(flat: np.ndarray, n: int, dim: int, scale: int) -> np.ndarray:
    out = np.floor(flat.astype(np.float64) * scale)
    bound = 2.0**62 / max(dim, 1)
    if out.size and 4 * float(np.abs(out).max()) ** 2 >= bound:
        raise ValueError(f"components beyond {np.sqrt(bound / 4) / scale:.6g} have squared errors that no 64-bit integer holds")
    return out.astype(np.int64).reshape(n, dim)


@dataclass
class Codebooks:
    """Integer entries [part, entry, component within part]."""

    entries: np.ndarray
    scale: int

    @property
    def dim(self) -> int:
        return self.entries.shape[0] * self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def trees(self) -> list[Gnat]:
        return [Gnat(e) for e in self.entries]

    def decode(self, code: str) -> np.ndarray:
        """The vector that a code stands for."""
        at = np.frombuffer(bytes.fromhex(code), np.uint8)
        return self.entries[np.arange(len(at)), at].ravel() / self.scale


def dimension(vectors: DataFrame) -> int:
    """The length that most vectors have (of equally many the greater; 0 for an empty table)."""
    found = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return found.d if found else 0


def _assigned(batch: pa.RecordBatch, books: Codebooks, trees: list[Gnat], col: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end, parts, indices and squared distances [rows, parts]) of slices of a batch."""
    parts, _, width = books.entries.shape
    for a in range(0, batch.num_rows, BATCH_ROWS):
        b = min(a + BATCH_ROWS, batch.num_rows)
        flat = batch.column(batch.schema.get_field_index(col)).slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
        x = _integers(flat, b - a, parts * width, books.scale).reshape(b - a, parts, width)
        found = [tree.search(np.ascontiguousarray(x[:, p])) for p, tree in enumerate(trees)]
        yield a, b, x, np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def learn(vectors: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> Codebooks:
    """Codebooks of the vectors that have the table's usual length.

    They start as the parts of the ``entries`` smallest ids (null ids last, repeated ids by their vectors; fewer, if there are fewer
    vectors); a round assigns every part and replaces each entry by the floor of its parts' mean (unused ones stay).
    """
    dim = dimension(vectors)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components can't be cut into {parts} equal parts")
    usual = vectors.where(F.size("v") == dim)
    first = usual.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = _integers(np.array([x for r in first for x in r.v], np.float64), len(first), dim, scale)
    books = Codebooks(start.reshape(len(first), parts, dim // parts).transpose(1, 0, 2).copy(), scale)
    if not first:
        return books
    width = dim // parts
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    for _ in range(rounds):
        partial = usual.select("v").mapInArrow(_sums(books), "part int, entry int, n bigint, sums array<bigint>")
        new = books.entries.copy()
        for part, entry, n, *total in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # parts x entries rows
            new[part, entry] = [s // n for s in total]
        books = Codebooks(new, scale)
    return books


def _sums(books: Codebooks):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, k, width = books.entries.shape
        trees = books.trees()
        totals, counts = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            for _, _, x, index, _ in _assigned(batch, books, trees, "v"):
                for p in range(parts):
                    np.add.at(totals[p], index[:, p], x[:, p])
                    counts[p] += np.bincount(index[:, p], minlength=k)
        part, entry = np.nonzero(counts)
        own = totals[part, entry]
        at = pa.array(np.arange(len(part) + 1) * width, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()), pa.ListArray.from_arrays(at, pa.array(own.ravel(), pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    return run


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """``id, label, code, error``: two hex digits a part, and the squared distances summed.

    A vector of another length than the codebooks' has neither (null).
    """
    kind = vectors.schema["label"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.trees()
        for batch in batches:
            for a, b, _, index, d2 in _assigned(batch, books, trees, "v"):
                codes = [row.tobytes().hex() for row in index.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(codes, pa.string()), pa.array(d2.sum(axis=1), pa.int64())], names=["id", "label", "code", "error"]
                )

    fits = F.size("v") == books.dim
    coded = vectors.where(fits).mapInArrow(run, f"id bigint, label {kind}, code string, error bigint")
    return coded.unionByName(vectors.where(~fits).select("id", "label"), allowMissingColumns=True)


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the errors summed over equal labels (nulls together).

    The sums of labels that hold more than ``HOT_SHARE`` of the rows are broadcast (at most ``1 / HOT_SHARE`` of them); the
    others are joined by a shuffle in which no key is hot.
    """
    totals = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows")), "label-errors")
    n = totals.agg(F.sum("_rows")).first()[0] or 0
    hot = totals.where(F.col("_rows") > n * HOT_SHARE).select(F.col("label").alias("_label"), "label_error", F.lit(True).alias("_hot"))
    cold = totals.where(F.col("_rows") <= n * HOT_SHARE).select(F.col("label").alias("_label"), "label_error")
    near = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
    rest = near.where(F.col("_hot").isNull()).drop("label_error", "_hot")
    far = rest.join(cold, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    return near.where(F.col("_hot").isNotNull()).drop("_hot").unionByName(far)


def compress(df: DataFrame, parts: int, entries: int, rounds: int, scale: int, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks]:
    """(``id, label, code, error, label_error`` of every kept row, codebooks).

    Rows whose vector is null or holds null or non-finite components are dropped.  Vectors of another length than
    most are returned without code and error and take no part in the codebooks.  Repeated rows and equal vectors get
    equal codes; an empty table gives no rows; other columns are ignored.  Components are limited to those whose squared
    errors fit 64 bits (an error says so).
    """
    if entries > 256:
        raise ValueError("two hex digits hold 256 entries")
    vectors = whole_vectors(df, id_col, vec_col, label_col)
    books = learn(vectors, parts, entries, rounds, scale)
    return with_label_error(materialize(encode(vectors, books), "codes")), books
