"""One ticker holding most of the rows: every operator must give the same answer through the
hot-key path (range sequence + chunks + halo) as through the ordinary per-ticker path."""

from __future__ import annotations

import pandas as pd
import pytest
from conftest import collect_sorted, seasonal_bars, to_bars
from pyspark.sql import functions as F

from barspark.functions.features import ENGINEERED_V2
from barspark.operators import metrics as M
from barspark.operators import performance as P
from barspark.operators import sequence as Q
from barspark.operators import validate as V
from barspark.operators.features import compute_features
from barspark.sources import fixtures as fx


@pytest.fixture(scope="module")
def skewed(spark):
    hot = seasonal_bars(1500, "HOT", seed=21)
    cold = [seasonal_bars(60, f"C{i}", seed=30 + i) for i in range(6)]
    return to_bars(spark, pd.concat([hot, *cold]).sample(frac=1, random_state=2))


def both_paths(monkeypatch, fn):
    plain = fn()
    monkeypatch.setattr(Q, "DEFAULT_CHUNK_ROWS", 97)
    chunked = fn()
    monkeypatch.setattr(Q, "DEFAULT_CHUNK_ROWS", 1 << 20)
    return plain, chunked


def test_prediction_evaluation(spark, skewed, monkeypatch):
    def run():
        log = fx.prediction_log(fx.bars_with_returns(skewed))
        ev = P.evaluate_predictions(log, skewed)
        return collect_sorted(ev.drop("timestamp"), by=("ticker", "prediction_date", "model_version"))

    plain, chunked = both_paths(monkeypatch, run)
    assert len(plain) > 1500 and (plain["status"] == "evaluated").sum() > 1000
    pd.testing.assert_frame_equal(plain, chunked)


def test_auc_by_ticker(spark, skewed, monkeypatch):
    scored = skewed.select(
        "ticker", (F.col("close") > F.col("open")).cast("int").alias("label"), F.round(F.col("volume") / 1e6, 1).alias("score")
    )
    plain, chunked = both_paths(monkeypatch, lambda: collect_sorted(M.roc_auc(scored, keys=["ticker"]), by=("ticker",)))
    pd.testing.assert_frame_equal(plain, chunked)


def test_v2_features_and_validation(spark, skewed, monkeypatch):
    plain, chunked = both_paths(monkeypatch, lambda: collect_sorted(compute_features(skewed, ENGINEERED_V2)))
    pd.testing.assert_frame_equal(plain, chunked, rtol=0, atol=1e-12)
    arrival = skewed.withColumn("arrival", F.unix_micros(F.col("date").cast("timestamp")))
    plain, chunked = both_paths(
        monkeypatch, lambda: collect_sorted(V.validation_report(arrival, arrival="arrival"), by=("ticker",))
    )
    pd.testing.assert_frame_equal(plain, chunked)
    assert plain.set_index("ticker").loc["C0", "first_violation"] == "too_few_rows"
