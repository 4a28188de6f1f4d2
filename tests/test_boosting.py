"""Second-order boosted trees against a plain implementation, and on awkward rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barspark.operators import boosting as B


def table(spark, x, y):
    rows = [(str(i), *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id string, " + ", ".join(f"x{j} double" for j in range(x.shape[1])) + ", label int")


def plain_tree(x, g, h, used, edges, columns, p, depth=0):
    """Nested (feature, threshold, left, right) or a leaf weight, by trying every cut."""
    best = None
    for j in columns if depth < p.depth else []:
        for e in edges[j]:
            left = used & (x[:, j] < e)
            right = used & ~(x[:, j] < e)
            hl, hr = h[left].sum(), h[right].sum()
            if min(hl, hr) < max(p.min_hessian, 1e-12):
                continue
            parts = [(g[s].sum() ** 2) / (h[s].sum() + p.ridge) for s in (left, right, used)]
            gain = parts[0] + parts[1] - parts[2]
            if gain > 0 and (best is None or round(gain, 9) > round(best[0], 9)):
                best = (gain, j, e)
    if best is None:
        return -p.rate * g[used].sum() / (h[used].sum() + p.ridge)
    _, j, e = best
    return j, e, plain_tree(x, g, h, used & (x[:, j] < e), edges, columns, p, depth + 1), plain_tree(x, g, h, used & ~(x[:, j] < e), edges, columns, p, depth + 1)


def reach(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 4)), 1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > 0)).astype(int)
    return x, y, table(spark, x, y)


def test_trees_equal_the_plain_ones(spark, data):
    x, y, df = data
    names = [f"x{j}" for j in range(4)]
    p = B.BoostParams(trees=3, depth=3, bins=8, rate=0.3, min_hessian=0.5)
    edges = B.quantile_edges(df, names, p.bins)
    model = B.fit_boosted(df.repartition(5), names, F.col("id"), p, watch=df, edges=edges)
    use = {(r["id"], t): r[f"t{t}"] for r in df.select("id", *[B.drawn(F.col("id"), t, p).alias(f"t{t}") for t in range(3)]).collect() for t in range(3)}
    margin = np.zeros(len(y))
    for t in range(3):
        used = np.array([use[str(i), t] for i in range(len(y))])
        assert 0.7 < used.mean() < 0.9
        prob = 1 / (1 + np.exp(-margin))
        columns = [names.index(c) for c in B.drawn_columns(names, t, p)]
        tree = plain_tree(x, prob - y, prob * (1 - prob), used, [edges[c] for c in names], columns, p)
        margin += [reach(tree, r) for r in x]
        assert model.log_losses[t] == pytest.approx(np.mean(np.log1p(np.exp(-np.abs(margin))) + np.maximum(margin, 0) - y * margin))
    got = {r["id"]: r["margin"] for r in model.with_margin(df).collect()}
    np.testing.assert_allclose([got[str(i)] for i in range(len(y))], margin, rtol=1e-9, atol=1e-12)
    assert model.table(spark).where("feature is null").count() == sum(n.feature is None for n in model.nodes)


def test_more_trees_learn_the_pattern_across_lineage_cuts(spark, data, monkeypatch):
    x, y, df = data
    monkeypatch.setattr(B, "CUT_TREES", 3)
    p = B.BoostParams(trees=8, depth=3, bins=16, rate=0.5, rows=1.0, columns=1.0)
    model = B.fit_boosted(df, [f"x{j}" for j in range(4)], F.col("id"), p, watch=df)
    assert model.log_losses == sorted(model.log_losses, reverse=True) and len(model.log_losses) == 8
    scored = model.predict(df).select("label", "prediction", "probability").toPandas()
    assert (scored["label"] == scored["prediction"]).mean() > 0.95 and scored["probability"].between(0, 1).all()


def test_constant_features_one_class_and_no_rows(spark, data):
    names, p = ["x0", "x1"], B.BoostParams(trees=2, depth=2, rows=1.0, columns=1.0, bins=4)
    same = table(spark, np.ones((20, 2)), np.arange(20) % 2)
    model = B.fit_boosted(same, names, F.col("id"), p, watch=same.limit(0))
    assert [(n.number, n.feature) for n in model.nodes] == [(1, None)] * 2 and all(math.isnan(v) for v in model.log_losses)
    assert {r["probability"] for r in model.predict(same).collect()} == {0.5}
    ones = B.fit_boosted(table(spark, data[0][:, :2], np.ones(300, int)), names, F.col("id"), p)
    assert min(r["probability"] for r in ones.predict(same).collect()) > 0.5
    none = B.fit_boosted(same.limit(0), names, F.col("id"), p)
    assert {r["probability"] for r in none.predict(same).collect()} == {0.5}


def test_even_edges_and_draws():
    p = B.BoostParams(columns=0.5)
    assert len(B.drawn_columns(list("abcdef"), 0, p)) == 3
    assert {tuple(B.drawn_columns(list("abcdef"), t, p)) for t in range(12)} != {tuple(B.drawn_columns(list("abcdef"), 0, p))}
