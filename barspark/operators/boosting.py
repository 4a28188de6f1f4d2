"""Second-order boosted trees on DataFrame aggregates (M1).

Each statistic is binned once.  A tree draws its rows (by a hash of their key) and its columns once and grows level by
level: one pass sums the gradients and hessians of the logistic loss by (node, feature, bin), combined map-side to at most
nodes x features x bins rows; running sums over the bins give every cut's gain, and only the best cut of each node comes
to the driver.  A child's sums are its parent's prefix or the rest, so leaves (Newton steps) need no pass of their own.
After each tree the watched rows' log loss is measured.

Margins are columns; every ``CUT_TREES`` trees the rows are written to the shared folder, which bounds the plans.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspark.session import materialize

CUT_TREES = 10
#: Gains that agree to so many places count as ties: the first feature, then the lowest cut, wins.
TIE_PLACES = 9


@dataclass(frozen=True)
class BoostParams:
    """The defaults equal the job's classifier; ``ridge`` and ``min_hessian`` are the usual ones of second-order boosting."""

    trees: int = 200
    depth: int = 4
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    seed: int = 42
    ridge: float = 1.0
    min_hessian: float = 1.0
    bins: int = 64


@dataclass
class Node:
    """``number``: 1 for the root, 2n and 2n + 1 for n's children; rows with a value under ``threshold`` go to the first."""

    tree: int
    number: int
    g: float
    h: float
    feature: str | None = None
    cut: int | None = None
    threshold: float | None = None
    gain: float | None = None


@dataclass
class BoostedTrees:
    features: list[str]
    params: BoostParams
    nodes: list[Node] = field(default_factory=list)
    log_losses: list[float] = field(default_factory=list)

    def weight(self, node: Node) -> float:
        return -self.params.rate * node.g / (node.h + self.params.ridge)

    def _tree(self, tree: int, goes_left) -> Column:
        """The weight of the leaf that a row reaches; ``goes_left(node)`` is the Column that sends it to the first child."""
        own = {n.number: n for n in self.nodes if n.tree == tree}

        def below(number: int) -> Column:
            node = own[number]
            if node.feature is None:
                return F.lit(self.weight(node))
            return F.when(goes_left(node), below(2 * number)).otherwise(below(2 * number + 1))

        return below(1)

    def with_margin(self, df: DataFrame, name: str = "margin") -> DataFrame:
        """Log odds from the raw features, JVM-side."""
        df = df.withColumn(name, F.lit(0.0))
        for tree in range(len(self.log_losses) or 1 + max((n.tree for n in self.nodes), default=-1)):
            df = df.withColumn(name, F.col(name) + self._tree(tree, lambda n: F.col(n.feature) < F.lit(n.threshold)))
        return df

    def predict(self, df: DataFrame) -> DataFrame:
        """``prediction`` (class) and ``probability`` beside the rows' own columns."""
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_margin")))
        out = self.with_margin(df, "_margin").withColumn("probability", p).drop("_margin")
        return out.withColumn("prediction", (F.col("probability") > 0.5).cast("int"))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row a node: the cut of an inner one, the weight of a leaf."""
        rows = [(n.tree, n.number, n.feature, n.cut, n.threshold, n.gain, n.h, None if n.feature else self.weight(n)) for n in self.nodes]
        return spark.createDataFrame(rows, "tree int, node int, feature string, cut int, threshold double, gain double, hessian double, weight double")

    def rounds(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.log_losses)), "tree int, log_loss double")


def even_edges(df: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Cuts of equal width between each feature's least and greatest value."""
    one = df.agg(*[f(c).alias(f"{k}_{c}") for c in features for k, f in (("lo", F.min), ("hi", F.max))]).first()
    lo, hi = ({c: one[f"{k}_{c}"] for c in features} for k in ("lo", "hi"))
    return {c: sorted({lo[c] + (hi[c] - lo[c]) * i / bins for i in range(1, bins)}) if lo[c] is not None and hi[c] > lo[c] else [] for c in features}


def quantile_edges(df: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Cuts at even quantiles, from mergeable sketches (one pass)."""
    at = [i / bins for i in range(1, bins)]
    one = df.agg(*[F.percentile_approx(c, at, 10_000).alias(c) for c in features], *[F.min(c).alias(f"lo_{c}") for c in features]).first()
    return {c: sorted({x for x in one[c] or [] if x > one[f"lo_{c}"]}) for c in features}


def _binned(df: DataFrame, edges: dict[str, list[float]], names: dict[str, str], keep: list[Column]) -> DataFrame:
    """``keep`` and each feature's bin: how many of its cuts are at or under the value."""
    cols = [c for c in edges if edges[c]]
    out = df
    if cols:
        splits = [[-math.inf, *edges[c], math.inf] for c in cols]
        out = Bucketizer(splitsArray=splits, inputCols=cols, outputCols=[f"{names[c]}_d" for c in cols], handleInvalid="error").transform(df)
    return out.select(*keep, *[(F.col(f"{names[c]}_d").cast("int") if c in cols else F.lit(0)).alias(names[c]) for c in edges])


def drawn(key: Column, tree: int, params: BoostParams) -> Column:
    """Whether a tree learns from a row: a hash of its key, the tree and the seed under the share."""
    text = F.concat(key, F.lit(f"|{tree}|{params.seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") < F.lit(int(params.rows * (1 << 32)))


def drawn_columns(features: list[str], tree: int, params: BoostParams) -> list[str]:
    """The columns of a tree, in the order of the features."""
    ranked = sorted(features, key=lambda c: hashlib.md5(f"{c}|{tree}|{params.seed}".encode()).hexdigest())
    chosen = set(ranked[: math.ceil(params.columns * len(features))])
    return [c for c in features if c in chosen]


def _best_cuts(rows: DataFrame, node: Column, features: list[str], names: dict[str, str], columns: list[str], params: BoostParams) -> list:
    """(node, G, H, and its best cut: feature, cut, gain, sums before it) of every node that ``node`` names."""
    cells = F.explode(F.array(*[F.struct(F.lit(features.index(c)).alias("f"), F.col(names[c]).alias("b")) for c in columns])).alias("cell")
    held = rows.select(node.alias("node"), "g", "h", cells).where(F.col("node").isNotNull())
    sums = held.groupBy("node", F.col("cell.f").alias("f"), F.col("cell.b").alias("b")).agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    whole = Window.partitionBy("node", "f")
    upto = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    cuts = sums.select(
        "node", "f", "b", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"), F.sum("g").over(whole).alias("gt"), F.sum("h").over(whole).alias("ht")
    )
    gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")

    def part(g, h):
        return g * g / (h + F.lit(params.ridge))

    gain = part(F.col("gl"), F.col("hl")) + part(gr, hr) - part(F.col("gt"), F.col("ht"))
    least = max(params.min_hessian, 1e-12)  # a cut with no row beyond it is none
    fits = (F.col("hl") >= least) & (hr >= least) & (gain > 0)
    ranked = cuts.withColumn("gain", F.when(fits, gain))
    order = F.struct(F.round("gain", TIE_PLACES), -F.col("f"), -F.col("b"))
    best = F.max_by(F.when(F.col("gain").isNotNull(), F.struct("f", "b", "gain", "gl", "hl")), F.when(F.col("gain").isNotNull(), order)).alias("best")
    return ranked.groupBy("node").agg(F.first("gt").alias("g"), F.first("ht").alias("h"), best).collect()


def fit_boosted(train: DataFrame, features: list[str], key: Column, params: BoostParams = BoostParams(), watch: DataFrame | None = None, label: str = "label", edges: dict[str, list[float]] | None = None) -> BoostedTrees:
    """Boosted trees of rows with a 0/1 ``label`` and no missing features; ``key`` names a row as text (its draws).

    ``watch`` (the test rows) plays no part in the trees; its log loss after each is in ``log_losses`` (NaN without rows).
    An empty training set gives trees of one leaf that weighs 0.
    """
    edges = edges or quantile_edges(train, features, params.bins)
    names = {c: f"b{i}" for i, c in enumerate(features)}
    keep = [key.alias("key"), F.col(label).cast("double").alias("y"), F.lit(0.0).alias("margin")]
    ordered = {c: edges[c] for c in features}
    rows = materialize(_binned(train, ordered, names, keep), "boost-rows")
    seen = None if watch is None else materialize(_binned(watch, ordered, names, keep), "boost-watch")
    model = BoostedTrees(features, params)
    for tree in range(params.trees):
        columns = drawn_columns(features, tree, params)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        own = rows.where(drawn(F.col("key"), tree, params)).withColumn("p", p).withColumns({"g": F.col("p") - F.col("y"), "h": F.greatest(F.col("p") * (1 - F.col("p")), F.lit(1e-16))})
        open_nodes, paths, nodes = [1], {1: F.lit(True)}, {1: Node(tree, 1, 0.0, 0.0)}
        for _ in range(params.depth):
            node = F.coalesce(*[F.when(paths[n], F.lit(n)) for n in open_nodes])
            found = {r["node"]: r for r in _best_cuts(own, node, features, names, columns, params)}  # at most 2^level rows
            if open_nodes == [1] and 1 in found:
                nodes[1].g, nodes[1].h = found[1]["g"], found[1]["h"]
            following = []
            for n in open_nodes:
                best = found[n]["best"] if n in found else None
                if best is None:
                    continue
                name, parent = features[best["f"]], nodes[n]
                parent.feature, parent.cut, parent.gain, parent.threshold = name, best["b"], best["gain"], edges[name][best["b"]]
                left = F.col(names[name]) <= best["b"]
                for child, side, g, h in ((2 * n, left, best["gl"], best["hl"]), (2 * n + 1, ~left, parent.g - best["gl"], parent.h - best["hl"])):
                    nodes[child], paths[child] = Node(tree, child, g, h), paths[n] & side
                    following.append(child)
            open_nodes = following
            if not open_nodes:
                break
        model.nodes += [nodes[n] for n in sorted(nodes)]
        step = model._tree(tree, lambda n: F.col(names[n.feature]) <= n.cut)
        rows = rows.withColumn("margin", F.col("margin") + step)
        if tree % CUT_TREES == CUT_TREES - 1:
            rows = materialize(rows, "boost-rows")
        if seen is not None:
            seen = seen.withColumn("margin", F.col("margin") + step)
            if tree % CUT_TREES == CUT_TREES - 1:
                seen = materialize(seen, "boost-watch")
            loss = F.log1p(F.exp(-F.abs("margin"))) + F.greatest(F.col("margin"), F.lit(0.0)) - F.col("y") * F.col("margin")
            model.log_losses.append(seen.agg(F.avg(loss)).first()[0])
    model.log_losses = [math.nan if x is None else x for x in model.log_losses]
    return model
