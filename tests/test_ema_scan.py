"""EMA and MACD by the scan of affine maps against the plain recursion."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import collect_sorted, seasonal_bars, to_bars

import __spark_entry__ as E
from barspark.operators.ema_scan import macd_scan


def recursion(close, fast=12, slow=26, signal=9):
    """The definition, one bar after the other."""
    out, state = [], None
    for x in close:
        state = (x, x, 0.0) if state is None else state
        f, s, g = state
        f += (x - f) * 2 / (fast + 1)
        s += (x - s) * 2 / (slow + 1)
        g += (f - s - g) * 2 / (signal + 1)
        state = (f, s, g)
        out.append((f, s, f - s, g))
    return np.array(out)


@pytest.mark.parametrize("chunk,block,fan", [(None, 1024, 64), (None, 7, 3), (50, 8, 2), (33, 33, 2), (1, 1, 2)])
def test_scan_equals_the_recursion_for_any_cut(spark, chunk, block, fan):
    pdf = pd.concat([seasonal_bars(257, "AAA", seed=1), seasonal_bars(41, "BBB", seed=2), seasonal_bars(1, "CCC")])
    bars = to_bars(spark, pdf.sample(frac=1, random_state=3))
    got = collect_sorted(macd_scan(bars, chunk_rows=chunk, block_rows=block, fan=fan))
    for ticker, own in pdf.groupby("ticker"):
        mine = got[got.ticker == ticker][["ema_12", "ema_26", "macd", "macd_signal"]].to_numpy()
        np.testing.assert_allclose(mine, recursion(own["close"]), rtol=1e-11, atol=1e-11)


def test_long_series_with_large_and_tiny_closes(spark):
    rng = np.random.default_rng(4)
    pdf = seasonal_bars(4000, "AAA").assign(close=np.exp(rng.normal(0, 8, 4000)))
    got = collect_sorted(macd_scan(to_bars(spark, pdf)))
    want = recursion(pdf["close"])
    for j, name in enumerate(["ema_12", "ema_26", "macd", "macd_signal"]):
        scale = np.maximum.accumulate(np.abs(want[:, :2]).max(axis=1))
        assert (np.abs(got[name].to_numpy() - want[:, j]) / scale).max() < 1e-11


def test_bars_without_a_close_and_empty_tables(spark):
    pdf = seasonal_bars(60, "AAA")
    pdf.loc[[0, 17, 59], "close"] = np.nan
    bars = to_bars(spark, pdf)
    got = collect_sorted(macd_scan(bars, block_rows=8))
    held = pdf["close"].notna().to_numpy()
    assert len(got) == 60 and got.loc[~held, "macd_signal"].isna().all()
    np.testing.assert_allclose(got.loc[held, "macd_signal"].to_numpy(), recursion(pdf["close"][held])[:, 3], rtol=1e-11, atol=1e-11)
    assert macd_scan(bars.limit(0)).count() == 0


def test_other_spans_and_refused_ones(spark):
    pdf = seasonal_bars(90, "AAA")
    got = collect_sorted(macd_scan(to_bars(spark, pdf), fast=5, slow=40, signal=3, block_rows=20))
    np.testing.assert_allclose(got[["ema_5", "ema_40", "macd", "macd_signal"]].to_numpy(), recursion(pdf["close"], 5, 40, 3), rtol=1e-11, atol=1e-11)
    with pytest.raises(ValueError, match="overflow"):
        macd_scan(to_bars(spark, pdf), block_rows=1 << 20)
    with pytest.raises(ValueError, match="differ"):
        macd_scan(to_bars(spark, pdf), fast=9, signal=9)


@pytest.mark.parametrize("name", ["ema_scan", "macd_signal_scan"])
def test_no_python_in_the_plan(spark, name):
    df = E.queries()[name](spark, "/root/testdata/sf0.001")
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def test_scan_tasks_are_sized_by_rows(spark, monkeypatch):
    from barspark.operators import sequence as Q

    pdf = pd.concat([seasonal_bars(257, "AAA", seed=1), seasonal_bars(41, "BBB", seed=2)])
    monkeypatch.setattr(Q, "TASK_ROWS", 20)
    monkeypatch.setattr(Q, "BROADCAST_BYTES", 0)
    for cap in (None, "1"):  # hot tickers listed, and too many to list
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            if cap:
                spark.conf.set(Q.MAX_HOT_KEYS_CONF, cap)
            df = macd_scan(to_bars(spark, pdf), chunk_rows=32, block_rows=8, fan=2)
            assert df.rdd.getNumPartitions() >= 15  # 8 in the session
            got = collect_sorted(df)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.unset(Q.MAX_HOT_KEYS_CONF)
        for ticker, own in pdf.groupby("ticker"):
            mine = got[got.ticker == ticker][["ema_12", "ema_26", "macd", "macd_signal"]].to_numpy()
            np.testing.assert_allclose(mine, recursion(own["close"]), rtol=1e-11, atol=1e-11)
