"""Quality scores by histogram gradient-boosted trees over document statistics.

Every whole text gives ``STATISTICS`` (counts and shares of characters, words, lines and repeats).  The model learns
from the statistics of a bounded sample of labelled documents: each statistic is cut into at most ``BINS`` bins by
its quantiles, and each tree grows level by level from the gradients and hessians of the logistic loss summed by (node,
statistic, bin); leaves hold Newton steps.  The finished trees are flattened into arrays (statistic, threshold, first child,
value) that numpy walks for a batch of documents and all trees at once.

Counting the labels and drawing the sample are DataFrame work; the sample's statistics (``SAMPLE`` rows at most, a
documented bound) meet in one task, which fits the trees; the arrays (a few thousand numbers) travel with the
scoring tasks, which are map-only and read every row.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import text_slices

#: Labelled documents that the model learns from, drawn by the hash of their id (whole texts).
SAMPLE = 16_384
TREES, DEPTH, BINS, RATE = 100, 4, 64, 0.1
#: Ridge on leaf values, least hessian of a leaf, and least gain of a split.
RIDGE, LEAST_HESSIAN, LEAST_GAIN = 1.0, 1.0, 1e-6

STATISTICS = [
    "log_chars", "log_words", "log_lines", "word_length", "word_length_deviation", "long_words", "short_words", "words_without_letters",
    "distinct_words", "commonest_word", "repeated_words", "distinct_pairs", "words_a_line", "distinct_lines", "longest_line",
    "digits", "capitals", "stops", "commas", "marks", "symbols", "spaces", "control", "beyond_ascii", "entropy", "words_a_stop",
]
_CLASSES = {
    "digits": b"0123456789",
    "capitals": bytes(range(65, 91)),
    "stops": b".!?",
    "commas": b",;:",
    "marks": b"\"'()-",
    "symbols": b"#$%&*+/<=>@[\\]^_`{|}~",
    "spaces": b" \t\n\r",
    "control": bytes(b for b in range(32) if b not in b" \t\n\r") + b"\x7f",
    "beyond_ascii": bytes(range(0xC0, 256)),
}
_OF_CLASS = np.array([[b in own for own in _CLASSES.values()] for b in range(256)], np.float64)
_NO_LETTER = frozenset("0123456789.,;:!?|#*-_=+<>/\\()[]{}\"'%&$@~^`")


def statistics(text: str) -> list[float]:
    """``STATISTICS`` of a whole text; an empty one gives zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = text.encode("utf-8", "replace")
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = by_byte / len(raw)
    seen = shares[shares > 0]
    classes = shares @ _OF_CLASS
    words = text.split()
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    lines = text.split("\n")
    count = Counter(words)
    pairs = n - 1
    repeats = sum(map(str.__eq__, words[1:], words))
    at_least = max(n, 1)
    return [
        math.log1p(len(text)), math.log1p(n), math.log1p(len(lines)),
        float(sizes.mean()) if n else 0.0, float(sizes.std()) if n else 0.0, float((sizes > 15).sum()) / at_least, float((sizes < 4).sum()) / at_least,
        sum(c for w, c in count.items() if _NO_LETTER.issuperset(w)) / at_least,
        len(count) / at_least, max(count.values(), default=0) / at_least, repeats / max(pairs, 1), len(set(zip(words, words[1:]))) / max(pairs, 1),
        n / len(lines), len(set(lines)) / len(lines), max(map(len, lines)) / len(text),
        *classes.tolist(), float(-(seen * np.log2(seen)).sum()), n / (1.0 + float(by_byte[list(b".!?")].sum())),
    ]


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))


@dataclass
class Trees:
    """Flattened trees of one depth: node i of a tree splits on ``feature[i]`` at ``threshold[i]`` (up to it: first child,
    beyond: second), its children stand at ``child[i]`` and ``child[i] + 1``; ``roots`` are the trees' first nodes."""

    base: float
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of every row: all trees walked level by level."""
        if not len(self.roots):
            return np.full(len(x), self.base)
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = self.child[at] + (x[rows, self.feature[at]] > self.threshold[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -40, 40)))


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Thresholds of every column: distinct values at even quantiles (the greatest left out, as no value lies beyond)."""
    out = []
    for col in x.T:
        cuts = np.unique(np.quantile(col, np.arange(1, bins) / bins, method="lower")) if len(col) else np.zeros(0)
        out.append(cuts[cuts < col.max()] if len(col) else cuts)
    return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Trees:
    """Boosted trees of the logistic loss.  No rows: log odds 0; rows of one label: smoothed log odds and no trees."""
    ones = float(y.sum())
    base = math.log((ones + 0.5) / (len(y) - ones + 0.5))
    empty = Trees(base, depth, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0))
    if ones in (0.0, float(len(y))):
        return empty
    edges = bin_edges(x, bins)
    cells = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, x.T)], axis=1)  # bin b: up to edge b
    width, wide = x.shape[1], bins
    shifted = cells + np.arange(width) * wide
    usable = np.array([[b < len(e) for b in range(wide)] for e in edges])
    margin = np.full(len(y), base)
    per_tree = 2 ** (depth + 1) - 1
    feature, threshold, value = (np.zeros(trees * per_tree, t) for t in (np.int64, np.float64, np.float64))
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-12)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            count, first = 2**level, t * per_tree + 2**level - 1
            flat = (node[:, None] * (width * wide) + shifted).ravel()
            sums = [np.bincount(flat, np.repeat(v, width), count * width * wide).reshape(count, width, wide).cumsum(axis=2) for v in (g, h)]
            (gl, hl), (gt, ht) = sums, (s[:, :, -1:] for s in sums)
            gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
            gain = np.where(usable & (hl >= LEAST_HESSIAN) & (ht - hl >= LEAST_HESSIAN), gain, -np.inf).reshape(count, -1)
            best = gain.argmax(axis=1)
            split = gain[np.arange(count), best] > LEAST_GAIN
            chosen, cell = best // wide, best % wide
            feature[first : first + count] = np.where(split, chosen, 0)
            # a node that is not split sends all rows to its first child
            threshold[first : first + count] = [edges[f][b] if s else np.inf for s, f, b in zip(split, chosen, cell)]
            right = split[node] & (cells[np.arange(len(y)), chosen[node]] > cell[node])
            node = 2 * node + right
        leaves = 2**depth
        step = -rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + RIDGE)
        value[t * per_tree + leaves - 1 : (t + 1) * per_tree] = step
        margin += step[node]
    places = np.arange(trees * per_tree) % per_tree
    child = (np.arange(trees * per_tree) - places) + 2 * places + 1
    child[places >= 2**depth - 1] = 0  # leaves
    return Trees(base, depth, np.arange(trees) * per_tree, feature, threshold, child, value)


def _drawn(labels: DataFrame, sample: int) -> DataFrame:
    """Distinct (id, label) of labelled ids whose hash lies below the share that gives ``sample`` of them."""
    n = labels.count()
    share = min(1.0, 0.95 * sample / n) if n > sample else 1.0
    drawn = labels.where(F.pmod(F.xxhash64(F.lit("quality"), "id"), F.lit(1 << 40)) <= int(share * (1 << 40)))
    return drawn.distinct()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees learnt from at most about ``sample`` documents that ``labels`` marks (over 0: 1, else 0).

    Null ids and null labels are left out; an id with both labels is learnt with both; of documents that repeat an id one
    is learnt (the least statistics).  Null text counts as empty.  Without labelled documents every score is 0.5.
    """
    marked = labels.select(F.col(label_id).cast("bigint").alias("id"), (F.col(label_col) > 0).cast("int").alias("label")).where("id is not null and label is not null")
    drawn = _drawn(marked.distinct(), sample)
    ids = F.broadcast(drawn.select("id").distinct())  # about `sample` numbers
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("t")).join(ids, "id", "left_semi")
    rows = texts.mapInArrow(_statistics_rows, "id bigint, x array<double>").groupBy("id").agg(F.min("x").alias("x")).join(F.broadcast(drawn), "id")

    def learn(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["label"].to_numpy(), table["id"].to_numpy()))
        x = np.array(table["x"].to_pylist(), np.float64).reshape(table.num_rows, len(STATISTICS))[order]
        m = fit_trees(x, table["label"].to_numpy()[order].astype(np.float64))
        cols = {"base": pa.array([m.base]), "roots": pa.array([m.roots.tolist()], pa.list_(pa.int64())), "feature": pa.array([m.feature.tolist()], pa.list_(pa.int64()))}
        cols |= {"threshold": pa.array([m.threshold.tolist()], pa.list_(pa.float64())), "child": pa.array([m.child.tolist()], pa.list_(pa.int64()))}
        return pa.table(cols | {"value": pa.array([m.value.tolist()], pa.list_(pa.float64()))})

    schema = "base double, roots array<bigint>, feature array<bigint>, threshold array<double>, child array<bigint>, value array<double>"
    got = rows.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(learn, schema).collect()  # one row of flattened trees
    if not got:
        return fit_trees(np.zeros((0, len(STATISTICS))), np.zeros(0))
    m = got[0]
    return Trees(m.base, DEPTH, np.array(m.roots, np.int64), np.array(m.feature, np.int64), np.array(m.threshold), np.array(m.child, np.int64), np.array(m.value))


def _statistics_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches, "t"):
        x = _matrix(texts)
        at = pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32())
        yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], names=["id", "x"])


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` (probability of label 1, over 0 and under 1) of every row, from its whole text alone.

    Null text scores as an empty one; repeated rows score alike; an empty table gives no rows; other columns are
    ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, "t"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.probability(_matrix(texts)))], names=["id", "score"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "id bigint, score double")


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id as text leaves 0 modulo 5 (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
