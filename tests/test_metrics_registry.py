from __future__ import annotations

import math
import random

import pytest

from barspark.operators import metrics as M
from barspark.operators import registry as R
from barspark.schemas import RUNS


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    total = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return total / (len(pos) * len(neg))


@pytest.mark.parametrize("chunk_rows", [None, 7])
def test_auc_equals_brute_force_with_ties(spark, monkeypatch, chunk_rows):
    from barspark.operators import sequence

    if chunk_rows:
        monkeypatch.setattr(sequence, "DEFAULT_CHUNK_ROWS", chunk_rows)
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = M.roc_auc(df).first()["roc_auc"]
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_single_class_is_nan(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double")
    assert math.isnan(M.roc_auc(df).first()["roc_auc"])


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (0, 0, 0.1)], "label int, prediction int, score double")
    m = M.classification_metrics(df).first()
    assert m["accuracy"] == 0.5 and m["precision_class1"] == 0.5 and m["recall_class1"] == 0.5
    assert m["f1_class1"] == 0.5 and m["label_balance"] == 0.5 and m["roc_auc"] == 0.75


def test_no_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0, 0.4), (0, 0, 0.1)], "label int, prediction int, score double")
    m = M.classification_metrics(df).first()
    assert m["precision_class1"] == 0.0 and m["f1_class1"] == 0.0 and m["recall_class1"] == 0.0


def runs(spark, aucs, model="m"):
    rows = [(f"r{i}", model, i, a, False, None, {}, {}) for i, a in enumerate(aucs)]
    return spark.createDataFrame(rows, RUNS)


def history(spark, aucs):
    return [r.asDict() for r in R.promotion_history(runs(spark, aucs)).orderBy("run_seq").collect()]


def test_promotion_rules(spark):
    assert [h["promoted"] for h in history(spark, [0.50])] == [True]
    assert [h["promoted"] for h in history(spark, [0.50, 0.505])] == [True, True]
    assert [h["promoted"] for h in history(spark, [0.50, 0.504])] == [True, False]
    h = history(spark, [0.50, 0.504, 0.508])
    assert [x["promoted"] for x in h] == [True, False, True] and h[-1]["champion_version"] == 3


def test_missing_auc_counts_as_zero_and_nan_blocks(spark):
    h = history(spark, [None, 0.004, 0.006])
    assert [x["promoted"] for x in h] == [True, False, True]
    h = history(spark, [float("nan"), 0.9])
    assert [x["promoted"] for x in h] == [True, False] and h[0]["nan_champion"]


def test_versions_alias_and_champion(spark):
    r = runs(spark, [0.50, 0.53, 0.52])
    v = {x["run_id"]: x["version"] for x in R.run_versions(r).collect()}
    assert v == {"r0": 1, "r1": 2, "r2": 3}
    hist = R.promotion_history(r)
    alias = sorted((x["version"], x["valid_to_seq"]) for x in R.alias_history(hist).collect())
    assert alias == [(1, 1), (2, None)]
    champ = R.current_champion(hist).first()
    assert champ["champion_version"] == 2 and champ["champion_run_id"] == "r1"
    assert R.champion_metrics(hist, r).first()["roc_auc"] == 0.53


def test_dry_runs_get_no_version(spark):
    rows = [("a", "m", 0, 0.5, False, None, {}, {}), ("b", "m", 1, 0.9, True, None, {}, {})]
    assert R.run_versions(spark.createDataFrame(rows, RUNS)).count() == 1


def test_single_decision():
    assert R.decide(0.5, None) and R.decide(0.505, 0.50) and not R.decide(0.504, 0.50)
    assert R.decide(None, -0.01) and not R.decide(None, 0.0)
