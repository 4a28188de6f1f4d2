from __future__ import annotations

import pandas as pd
import pytest
from conftest import seasonal_bars, to_bars

from barspark.plans import scoring
from barspark.plans import training_jobs as J


@pytest.fixture(scope="module")
def bars(spark):
    pdf = pd.concat([seasonal_bars(400, t, seed=i, start="2023-01-02") for i, t in enumerate(["AAPL", "MSFT", "TSLA"])])
    return to_bars(spark, pdf)


def test_training_jobs_and_champion(spark, bars, tmp_path):
    root = str(tmp_path)
    with pytest.raises(RuntimeError, match="no champion yet"):
        J.load_champion(spark, root)
    base = J.run_baseline(spark, bars, root, split_date="2024-01-01", params={"n_estimators": 3})
    assert set(base.metrics) >= {"accuracy", "roc_auc", "precision_class1", "recall_class1", "f1_class1", "label_balance"}
    res, promoted = J.run_dated(spark, bars, root, "2024-06-01", params={"n_estimators": 3})
    assert res.params["test_split_date"] == "2024-03-03" and res.params["feature_set_version"] == 2
    assert J.read_runs(spark, root).count() == 2
    assert promoted  # first engineered run: no champion yet
    _, _ = J.run_dated(spark, bars, root, "2024-06-01", dry_run=True, params={"n_estimators": 3})
    assert J.read_runs(spark, root).count() == 2  # dry run writes nothing
    model, version = J.load_champion(spark, root)
    reqs = spark.createDataFrame([("AAPL",), ("NOPE",)], "ticker string")
    out, errors = scoring.score_requests(reqs, bars, model, version, None)
    row = out.first()
    assert row["ticker"] == "AAPL" and row["direction"] in ("UP", "DOWN") and 0 <= row["probability"] <= 1
    assert [r["ticker"] for r in errors.collect()] == ["NOPE"]
    # every request comes out once, with its own columns: twice the same ticker, one unknown, one with too few bars
    short = to_bars(spark, seasonal_bars(30, "TINY"))
    reqs = spark.createDataFrame([("AAPL", 1), ("AAPL", 2), ("NOPE", 3), ("TINY", 4)], "ticker string, request int")
    out, errors = scoring.score_requests(reqs, bars.unionByName(short), model, version, None)
    assert sorted(r["request"] for r in out.collect()) == [1, 2]
    assert {r["request"]: r["status"] for r in errors.collect()} == {3: "unknown_ticker", 4: "short_history"}


def test_entry_and_registered_queries_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    for name in ("features_v2", "prediction_summary", "promotion_history", "roc_auc"):
        assert qs[name](spark, "/root/testdata/sf0.001").count() >= 0


def test_streaming_scorer_logs_predictions(spark, bars, tmp_path):
    from barspark.sources import predlog

    root, reqs, log, ckpt = (str(tmp_path / n) for n in ("root", "reqs", "log", "ckpt"))
    J.run_dated(spark, bars, root, "2024-06-01", params={"n_estimators": 3})
    spark.createDataFrame([("AAPL",), ("TSLA",), ("NOPE",)], "ticker string").write.json(reqs)
    stream = spark.readStream.schema("ticker string").json(reqs)
    scoring.serve_stream(stream, lambda s: bars, root, log, ckpt)
    logged = predlog.read_predictions(spark, log).toPandas()
    assert sorted(logged["ticker"]) == ["AAPL", "TSLA"]  # the unknown ticker is an error, not a log row
    refused = spark.read.json(f"{log}_errors").toPandas()
    assert refused[["ticker", "status"]].values.tolist() == [["NOPE", "unknown_ticker"]]
    assert set(logged["direction"]) <= {"UP", "DOWN"} and (logged["model_version"] == "1").all()
