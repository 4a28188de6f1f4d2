"""Drift flags (reference cases + NaN/threshold edges) and prediction back-evaluation."""

from __future__ import annotations


import pandas as pd
from conftest import to_bars
from pyspark.sql import functions as F

from barspark.operators.drift import drift_columns
from barspark.operators import performance as P
from barspark.schemas import PREDICTION_LOG
from barspark.sources import predlog

STATS = {"return_1d": (0.001, 0.015), "volatility_5d": (0.012, 0.005), "rsi_14": (55.0, 10.0)}
NAMES = ["return_1d", "volatility_5d", "rsi_14", "unknown"]


def flags(spark, row: dict, stats=STATS, n_sigma=3.0):
    df = spark.createDataFrame([tuple(row.get(n) for n in NAMES)], ", ".join(f"{n} double" for n in NAMES))
    return df.withColumns(drift_columns(NAMES, stats, n_sigma)).first()


def test_in_bounds(spark):
    r = flags(spark, {"return_1d": 0.02, "volatility_5d": 0.010, "rsi_14": 55.0})
    assert r["drift_detected"] is False and r["drifted_features"] == []


def test_beyond_and_several(spark):
    assert flags(spark, {"return_1d": 0.10, "volatility_5d": 0.010, "rsi_14": 55.0})["drifted_features"] == ["return_1d"]
    r = flags(spark, {"return_1d": 0.10, "volatility_5d": 0.012, "rsi_14": 110.0})
    assert r["drifted_features"] == ["return_1d", "rsi_14"] and r["drift_detected"]


def test_unknown_feature_and_degenerate_stats(spark):
    assert flags(spark, {"unknown": 1e9})["drifted_features"] == []
    assert flags(spark, {"return_1d": 5.0}, {"return_1d": (0.0, 0.0)})["drifted_features"] == []
    assert flags(spark, {"return_1d": 5.0}, {"return_1d": (0.0, float("nan"))})["drifted_features"] == []
    assert flags(spark, {"return_1d": float("nan")})["drifted_features"] == []


def test_z_exactly_three_is_not_flagged(spark):
    assert flags(spark, {"rsi_14": 85.0})["drifted_features"] == []
    assert flags(spark, {"rsi_14": 85.0001})["drifted_features"] == ["rsi_14"]


def perf_bars(start_price, step, n=11, ticker="AAPL", start="2024-01-01"):
    vals = [start_price + step * i for i in range(n)]
    return pd.DataFrame({"ticker": ticker, "date": pd.bdate_range(start, periods=n), "open": vals, "high": vals,
                         "low": vals, "close": vals, "volume": 1e6})


def log(spark, rows):
    return spark.createDataFrame(
        [("2024-02-01T00:00:00+00:00", t, d, dirn, 0.7, "1") for t, d, dirn in rows], PREDICTION_LOG
    )


def evaluate(spark, bars_pdf, rows):
    ev = P.evaluate_predictions(log(spark, rows), to_bars(spark, bars_pdf))
    return ev.toPandas(), P.prediction_summary(ev).first()


def test_correct_and_incorrect(spark):
    _, s = evaluate(spark, perf_bars(100, 1), [("AAPL", "2024-01-01", "UP")])
    assert (s["evaluated"], s["pending"], s["skipped"], s["accuracy"]) == (1, 0, 0, 1.0)
    rows, s = evaluate(spark, perf_bars(100, -1), [("AAPL", "2024-01-01", "UP")])
    assert s["accuracy"] == 0.0 and rows["realized"].iloc[0] == "DOWN"
    assert rows["close_t"].iloc[0] == 100.0 and rows["close_forward"].iloc[0] == 95.0


def test_pending_and_skipped(spark):
    _, s = evaluate(spark, perf_bars(100, 1, n=3), [("AAPL", "2024-01-01", "UP")])
    assert (s["evaluated"], s["pending"]) == (0, 1)
    _, s = evaluate(spark, perf_bars(100, 1), [("AAPL", None, "UP"), ("AAPL", "  ", "UP"), ("ZZZZ", "2024-01-01", "UP")])
    assert (s["evaluated"], s["pending"], s["skipped"], s["accuracy"]) == (0, 0, 3, 0.0)


def test_nearest_bar_edges(spark):
    bars = perf_bars(100, 1)  # business days from Mon 2024-01-01
    rows, _ = evaluate(spark, bars, [
        ("AAPL", "2023-12-01", "UP"),   # before the first bar -> first bar
        ("AAPL", "2024-02-01", "UP"),   # after the last bar -> last bar (pending)
        ("AAPL", "2024-01-06 12:00:00", "UP"),  # Sat noon: Fri 5th is 1.5 d back, Mon 8th 1.5 d ahead -> later
        ("AAPL", "2024-01-06 11:00:00", "UP"),  # closer to Friday
    ])
    got = dict(zip(rows["prediction_date"], rows["bar_date"]))
    assert got["2023-12-01"] == pd.Timestamp("2024-01-01")
    assert got["2024-02-01"] == pd.Timestamp("2024-01-15")
    assert got["2024-01-06 12:00:00"] == pd.Timestamp("2024-01-08")
    assert got["2024-01-06 11:00:00"] == pd.Timestamp("2024-01-05")
    assert dict(zip(rows["prediction_date"], rows["status"]))["2024-02-01"] == "pending"


def test_empty_and_missing_log(spark, tmp_path):
    empty = predlog.read_predictions(spark, str(tmp_path / "nope"))
    assert empty.count() == 0
    s = P.prediction_summary(P.evaluate_predictions(empty, to_bars(spark, perf_bars(100, 1)))).first()
    assert (s["evaluated"], s["pending"], s["skipped"], s["accuracy"]) == (0, 0, 0, 0.0)


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    src = log(spark, [("AAPL", "2024-01-01", "UP")]).drop("timestamp")
    predlog.append_predictions(src, path)
    predlog.append_predictions(src, path)
    back = predlog.read_predictions(spark, path)
    assert back.count() == 2 and back.where(F.col("timestamp").isNull()).count() == 0


def test_latency_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(0.0005,), (0.003,), (0.2,), (0.9,)], "latency_seconds double")
    h = {r["le"]: r["bucket_count"] for r in P.latency_histogram(df).collect()}
    assert h["0.001"] == 1 and h["0.005"] == 2 and h["0.25"] == 3 and h["0.5"] == 3 and h["+Inf"] == 4


def test_session_time_zone_does_not_change_results(spark):
    """Wall-clock logic (bar hours, as-of distances, digests) must not depend on the session zone."""
    import __spark_entry__ as E

    from oracle_check import canon

    sf = "/root/testdata/sf0.001"
    names = ["features_v1", "nearest_bar", "fingerprint", "split_date", "prediction_log_roundtrip", "normalize_bars"]
    base = {n: canon(E.queries()[n](spark, sf).toPandas()) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for n in names:
            assert canon(E.queries()[n](spark, sf).toPandas()) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_log_timestamp_is_utc(spark, tmp_path):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        path = str(tmp_path / "log")
        predlog.append_predictions(log(spark, [("AAPL", "2024-01-01", "UP")]).drop("timestamp"), path)
        ts = predlog.read_predictions(spark, path).first()["timestamp"]
        assert ts.endswith("+00:00")
        now = pd.Timestamp.now(tz="UTC")
        assert abs((pd.Timestamp(ts) - now).total_seconds()) < 600
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
