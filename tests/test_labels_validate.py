from __future__ import annotations


import pandas as pd
import pytest
from conftest import collect_sorted, steady_bars, seasonal_bars, to_bars
from pyspark.sql import functions as F

from barspark.operators import labels as L
from barspark.operators.training import baseline_features, split_counts
from barspark.operators.validate import validate, validation_report


def prices(values, ticker="AAPL"):
    return pd.DataFrame(
        {"ticker": ticker, "date": pd.bdate_range("2024-01-01", periods=len(values)), "open": values,
         "high": values, "low": values, "close": values, "volume": 1e6}
    )


def test_up_and_down_labels(spark):
    up = collect_sorted(L.add_labels(to_bars(spark, prices([100.0] * 5 + [110.0]))))
    down = collect_sorted(L.add_labels(to_bars(spark, prices([100.0] * 5 + [90.0]))))
    assert up["label"].iloc[0] == 1 and down["label"].iloc[0] == 0


def test_equal_future_is_zero_and_tail_is_null(spark):
    got = collect_sorted(L.add_labels(to_bars(spark, prices([100.0] * 20))))
    assert (got["label"].iloc[:15] == 0).all()
    assert got["label"].iloc[15:].isna().all()
    assert L.drop_unlabeled(L.add_labels(to_bars(spark, prices([100.0] * 20)))).count() == 15


def test_labels_do_not_bleed_across_tickers(spark):
    a = prices([100.0, 99, 98, 97, 96, 95], "AAPL")
    b = prices([50.0, 51, 52, 53, 54, 999], "MSFT")
    got = collect_sorted(L.add_labels(to_bars(spark, pd.concat([b, a]))))
    assert got[got.ticker == "AAPL"]["label"].iloc[0] == 0
    assert got[got.ticker == "MSFT"]["label"].iloc[0] == 1
    assert got["label"].notna().sum() == 2


def test_labels_chunked_equal(spark):
    bars = to_bars(spark, seasonal_bars(500))
    plain = collect_sorted(L.add_labels(bars))
    chunked = collect_sorted(L.add_labels(bars, chunk_rows=37))
    pd.testing.assert_frame_equal(plain, chunked)


def test_time_split_and_split_date(spark):
    bars = to_bars(spark, seasonal_bars(100))
    train, test = L.time_split(bars, "2021-03-01")
    assert train.count() + test.count() == 100
    assert train.agg(F.max("date")).first()[0] < pd.Timestamp("2021-03-01")
    assert L.compute_split_date(spark, "2024-12-31") == "2024-10-02"
    assert L.compute_split_date(spark, "2024-06-01", 30) == "2024-05-02"
    d = spark.createDataFrame([("2024-12-31",)], "d string").select(L.split_date_column(F.col("d")).alias("s"))
    assert d.first()["s"] == "2024-10-02"
    counts = split_counts(bars, "2021-03-01").first()
    assert counts["train_rows"] + counts["test_rows"] == counts["total_rows"] == 100


def test_baseline_projection(spark):
    bars = to_bars(spark, steady_bars(10))
    assert baseline_features(bars).columns == ["ticker", "date", "open", "high", "low", "close", "volume"]
    with pytest.raises(ValueError, match="lack"):
        baseline_features(bars.drop("volume"))


def _violation(spark, pdf, **kw):
    return validation_report(to_bars(spark, pdf) if "arrival" not in pdf else spark.createDataFrame(pdf), **kw).first()


def test_validation_rules_in_order(spark):
    assert validation_report(to_bars(spark, steady_bars(200))).first()["first_violation"] is None
    assert validation_report(to_bars(spark, steady_bars(50))).first()["first_violation"] == "too_few_rows"
    nan = steady_bars(200)
    nan.loc[3, "close"] = float("nan")
    assert validation_report(to_bars(spark, nan)).first()["first_violation"] == "null_values"
    neg = steady_bars(200)
    neg.loc[3, "close"] = -1.0
    assert validation_report(to_bars(spark, neg)).first()["first_violation"] == "non_positive_close"
    vol = steady_bars(200)
    vol.loc[3, "volume"] = -5.0
    assert validation_report(to_bars(spark, vol)).first()["first_violation"] == "negative_volume"
    with pytest.raises(ValueError, match="lack the columns"):
        validation_report(to_bars(spark, steady_bars(200)).drop("volume"))
    with pytest.raises(ValueError, match="50 bars, 100 needed"):
        validate(to_bars(spark, steady_bars(50)))


def test_null_close_counts_like_nan(spark):
    pdf = steady_bars(200)
    pdf["close"] = pdf["close"].astype(object)
    pdf.loc[5, "close"] = None
    rep = validation_report(to_bars(spark, pdf)).first()
    assert rep["null_close"] == 1 and rep["first_violation"] == "null_values"


def test_unsorted_arrival(spark):
    pdf = steady_bars(200)
    pdf["arrival"] = range(200)
    pdf.loc[10, "arrival"], pdf.loc[11, "arrival"] = 11, 10  # two bars arrive swapped
    df = spark.createDataFrame(pdf)
    rep = validation_report(df, arrival="arrival").first()
    assert rep["unsorted_dates"] == 1 and rep["first_violation"] == "unsorted_dates"
    with pytest.raises(ValueError, match="unsorted_dates"):
        validate(df, arrival="arrival")


def test_purge_and_end_date(spark):
    bars = to_bars(spark, seasonal_bars(100))
    lab = L.add_labels(bars, with_horizon=True)
    train, test = L.time_split(lab, "2021-03-01", end_date="2021-04-01", purge=True)
    plain_train, plain_test = L.time_split(lab, "2021-03-01")
    assert plain_train.count() - train.count() == 5  # the five rows whose label looks past the split
    assert test.agg(F.max("date")).first()[0] < pd.Timestamp("2021-04-01")
    assert test.count() < plain_test.count()


def test_single_pass_training_frame_equals_join(spark):
    from barspark.functions.features import ENGINEERED_V2
    from barspark.operators.features import compute_features
    from barspark.operators.training import training_frame, training_set

    bars = to_bars(spark, pd.concat([seasonal_bars(300, "AAA", seed=1), seasonal_bars(200, "BBB", seed=2)]))
    joined = collect_sorted(training_set(L.add_labels(bars), compute_features(bars, ENGINEERED_V2), ENGINEERED_V2))
    single = collect_sorted(training_frame(bars, ENGINEERED_V2))
    pd.testing.assert_frame_equal(single, joined[single.columns])
    chunked = collect_sorted(training_frame(bars, ENGINEERED_V2, chunk_rows=700))
    pd.testing.assert_frame_equal(chunked, single, rtol=0, atol=1e-12)


def test_repeated_dates_are_reported_and_ordered_the_same_under_any_layout(spark):
    from barspark.functions.features import ENGINEERED_V1
    from barspark.operators.features import compute_features

    pdf = seasonal_bars(120)
    twice = pdf.iloc[[30, 60]].assign(close=lambda d: d["close"] + 5)
    bars = to_bars(spark, pd.concat([pdf, twice]))
    assert validation_report(bars).first()["repeated_dates"] == 2
    runs = [
        collect_sorted(compute_features(bars.repartition(n), ENGINEERED_V1, chunk_rows=c), by=("date", "return_1d"))
        for n, c in ((1, None), (7, None), (3, 40))
    ]
    for other in runs[1:]:
        pd.testing.assert_frame_equal(runs[0], other)
