"""Scores and metrics of the model queries, which no oracle can tell, by their properties (few trees)."""

from __future__ import annotations

from collections import Counter

import pytest
from conftest import seasonal_bars, to_bars
from oracle_check import canon, duck

from barspark.plans import catalog, scoring
from barspark.plans import training_jobs as J
from barspark.schemas import TICKER

SF = "/root/testdata/sf0.001"


@pytest.fixture
def few_trees(monkeypatch):
    monkeypatch.setitem(J.GBT_PARAMS, "n_estimators", 3)


def test_requests_keep_columns_named_like_the_responses(spark, few_trees, tmp_path):
    bars = to_bars(spark, seasonal_bars(400, "AAPL", start="2023-01-02"))
    J.run_dated(spark, bars, str(tmp_path), "2024-06-01")
    model, version = J.load_champion(spark, str(tmp_path))
    schema = "ticker string, prediction_date string, probability double, request_probability int, status string, rsi_14 int, features int"
    rows = [("AAPL", "2020-01-01", 0.25, 1, "a", 7, 8), ("AAPL", "2020-01-01", 0.25, 1, "a", 7, 8), ("NOPE", "x", 0.5, 2, "b", 7, 8)]
    out, errors = scoring.score_requests(spark.createDataFrame(rows, schema), bars, model, version, None)
    got = [r.asDict() for r in out.collect()]
    assert len(got) == 2 and got[0] == got[1]
    r = got[0]
    assert (r["request_prediction_date"], r["request_request_probability"], r["request_probability"], r["request_status"], r["request_rsi_14"], r["features"]) == ("2020-01-01", 0.25, 1, "a", 7, 8)
    assert r["prediction_date"] > "2024" and 0 <= r["probability"] <= 1 and r["rsi_14"] != 7
    (bad,) = [r.asDict() for r in errors.collect()]
    assert (bad["status"], bad["request_status"], bad["request_request_probability"]) == ("unknown_ticker", "b", 0.5)


def test_every_logged_row_is_scored_once(spark, few_trees, monkeypatch):
    scored = catalog._champion_scored(spark, SF)
    monkeypatch.setattr(catalog, "_champion_scored", lambda *_: scored)
    log_table = catalog._log(spark, SF)
    log = [tuple(r) for r in log_table.collect()]
    rows = [r.asDict() for r in catalog.q_champion_scores(spark, SF).collect()]
    back = [tuple(r[c] if c in ("ticker", "timestamp") else r[f"request_{c}"] for c in log_table.columns) for r in rows]
    assert Counter(back) == Counter(log) and len(log) > len({r["ticker"] for r in rows})
    for r in rows:
        if r["status"] == "ok":
            assert 0 <= r["probability"] <= 1 and r["direction"] == ("UP" if r["probability"] > 0.5 else "DOWN")
            assert r["model_version"] in ("1", "2") and r["drift_detected"] == bool(r["drifted_features"])
        else:
            assert r["probability"] is None and r["direction"] is None
    assert {r["status"] for r in rows} >= {"ok"}
    status = {r["ticker"]: (r["status"], r["prediction_date"]) for r in rows}
    small = catalog.q_champion_scoring(spark, SF).collect()
    assert {r[TICKER]: (r["status"], r["prediction_date"]) for r in small} == status and len(small) == len(status)
    assert all(r["in_range"] is (True if r["status"] == "ok" else None) for r in small)
    want = duck(SF).execute(catalog.ORACLES["champion_scoring"]).df()
    assert canon(catalog.q_champion_scoring(spark, SF).toPandas()) == canon(want)


def by_hand(label, predicted, p) -> dict[str, float]:
    tp = float(((label == 1) & (predicted == 1)).sum())
    precision, recall = (tp / n if n else 0.0 for n in ((predicted == 1).sum(), (label == 1).sum()))
    up, down = p[label == 1][:, None], p[label == 0][None, :]
    return {
        "accuracy": (label == predicted).mean(), "precision_class1": precision, "recall_class1": recall,
        "f1_class1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0,
        "roc_auc": ((up > down) + 0.5 * (up == down)).mean(), "label_balance": label.mean(),
    }


def test_metrics_follow_from_the_returned_predictions(spark, few_trees, monkeypatch):
    fitted = catalog._fitted(spark, SF)
    monkeypatch.setattr(catalog, "_fitted", lambda *_: fitted)
    rows = catalog.QUERIES["batch_prediction_scores"](spark, SF).toPandas()
    assert len(rows) == fitted[1].count() and ((rows["probability"] > 0.5) == (rows["prediction"] == 1)).all()
    assert rows["probability"].nunique() > 1  # a model that always says the same isn't fitted
    metrics = catalog.QUERIES["gbt_metric_values"](spark, SF).first().asDict()
    want = by_hand(*(rows[c].to_numpy(float) for c in ("label", "prediction", "probability")))
    assert {k: metrics[k] for k in want} == pytest.approx(want)


@pytest.mark.parametrize("name", ["baseline_run", "engineered_run"])
def test_runs_hold_the_metrics_of_their_model(spark, few_trees, monkeypatch, name):
    seen, evaluate = [], J.evaluate

    def recorded(model, test):
        scored = J.predict(model, test).select("label", "prediction", "probability").toPandas()
        seen.append(by_hand(*(scored[c].to_numpy(float) for c in scored)))
        return evaluate(model, test)

    monkeypatch.setattr(J, "evaluate", recorded)
    (run,) = catalog.QUERIES[f"{name}_metrics"](spark, SF).collect()
    assert {n: run[n] for n in catalog.RUN_METRICS} == pytest.approx({n: seen[0][n] for n in catalog.RUN_METRICS})
