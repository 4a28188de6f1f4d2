"""ST2 and ST3 on Spark's state store: repeats, late rows, idle tickers, retries, bounded state."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
import pytest
from conftest import collect_sorted, seasonal_bars, to_bars

from barspark.functions.features import ENGINEERED_V1, ENGINEERED_V2, macd_recursion, macd_signal_series
from barspark.operators.features import compute_features
from barspark.streaming.features import late_path, stream_features
from barspark.streaming.sources import bar_stream
from barspark.streaming.windows import stream_windows_chunked


@pytest.fixture
def places(tmp_path):
    return tuple(str(tmp_path / n) for n in ("src", "sink", "runs", "ckpt"))


def arrive(spark, pdf, src):
    to_bars(spark, pdf).coalesce(1).write.mode("append").parquet(src)


def run(spark, places, fs=ENGINEERED_V2, **more):
    src, sink, root, ckpt = places
    stream_features(bar_stream(spark, src, **more), fs, sink, root, ckpt)
    return collect_sorted(spark.read.parquet(sink).drop("epoch"))


def same(got, want):
    pd.testing.assert_frame_equal(got[want.columns], want, rtol=1e-10, atol=1e-12)


def test_recursion_continues_from_three_numbers():
    close = seasonal_bars(300)["close"]
    want, state, got = macd_signal_series(pd.DataFrame({"close": close})), None, []
    for a, b in [(0, 1), (1, 40), (40, 40), (40, 300)]:
        values, state = macd_recursion(close.to_numpy()[a:b], state)
        got.append(values)
    np.testing.assert_allclose(np.concatenate(got), want, rtol=1e-12, atol=1e-12)
    assert len(state) == 3 and macd_recursion(np.zeros(0), None)[1] is None


def test_many_small_micro_batches_equal_the_offline_table(spark, places):
    pdf = pd.concat([seasonal_bars(70, "AAA", seed=1), seasonal_bars(55, "BBB", seed=2)])
    days = pdf["date"].drop_duplicates().sort_values().to_list()
    for a, b in zip([0, 30, 50], [30, 50, 70]):
        arrive(spark, pdf[pdf["date"].isin(days[a:b])], places[0])
    got = run(spark, places, max_files_per_trigger=1)
    same(got, collect_sorted(compute_features(to_bars(spark, pdf), ENGINEERED_V2)))
    assert len([n for n in os.listdir(places[1]) if n.startswith("epoch=")]) == 3


def test_repeats_and_late_rows_leave_one_bar_and_a_count(spark, places):
    pdf = seasonal_bars(60, "AAA")
    twice = pdf.iloc[[10]].assign(close=1e6)
    arrive(spark, pd.concat([pdf.iloc[:40], twice]).sample(frac=1, random_state=1), places[0])
    run(spark, places)
    arrive(spark, pd.concat([pdf.iloc[40:], pdf.iloc[[3, 39]]]), places[0])
    same(run(spark, places), collect_sorted(compute_features(to_bars(spark, pdf), ENGINEERED_V2)))
    late = spark.read.parquet(late_path(places[1])).orderBy("epoch").collect()
    assert [r["late_rows"] for r in late] == [1, 2]
    # without a recursive feature rows pass the state unsorted and the repeat is dropped after it
    other = tuple(f"{p}-v1" if i else p for i, p in enumerate(places))
    same(run(spark, other, ENGINEERED_V1, max_files_per_trigger=1), collect_sorted(compute_features(to_bars(spark, pdf), ENGINEERED_V1)))
    assert sum(r["late_rows"] for r in spark.read.parquet(late_path(other[1])).collect()) == 3


def test_idle_tickers_keep_their_state(spark, places):
    a, b = seasonal_bars(60, "AAA", seed=1), seasonal_bars(60, "BBB", seed=2)
    arrive(spark, pd.concat([a.iloc[:30], b.iloc[:50]]), places[0])
    run(spark, places)
    arrive(spark, a.iloc[30:], places[0])
    run(spark, places)
    arrive(spark, b.iloc[50:], places[0])
    same(run(spark, places), collect_sorted(compute_features(to_bars(spark, pd.concat([a, b])), ENGINEERED_V2)))


def forget_last_commit(ckpt: str) -> None:
    """As if the driver had died after the epoch's output, before its commit."""
    commits = os.path.join(ckpt, "commits")
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))


def test_a_retried_epoch_writes_the_same_rows(spark, places):
    pdf = seasonal_bars(80, "AAA")
    arrive(spark, pdf.iloc[:50], places[0])
    run(spark, places)
    arrive(spark, pdf.iloc[50:], places[0])
    first = run(spark, places)
    forget_last_commit(places[3])
    again = run(spark, places)
    pd.testing.assert_frame_equal(first, again)
    same(again, collect_sorted(compute_features(to_bars(spark, pdf), ENGINEERED_V2)))


def test_windows_of_a_hot_ticker_are_cut_into_chunks(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    pdf = pd.concat([seasonal_bars(90, "HOT", seed=3), seasonal_bars(7, "COLD")])
    arrive(spark, pd.concat([pdf[pdf["date"] < "2021-03-15"], pdf.iloc[5:9]]).sample(frac=1, random_state=2), src)
    stream_windows_chunked(bar_stream(spark, src), 5, sink, ckpt, chunk_rows=8)
    arrive(spark, pd.concat([pdf[pdf["date"] >= "2021-03-15"], pdf.iloc[[0]]]), src)
    stream_windows_chunked(bar_stream(spark, src), 5, sink, ckpt, chunk_rows=8)
    got = spark.read.parquet(sink).toPandas().sort_values(["ticker", "window_end"])
    for ticker, own in pdf.groupby("ticker"):
        mine = got[got["ticker"] == ticker]
        sums = own["close"].rolling(5).sum().dropna()
        np.testing.assert_allclose(mine["close_sum"], sums, rtol=1e-12)
        assert mine["window_end"].to_list() == own["date"].iloc[4:].to_list() and mine["window_start"].to_list() == own["date"].iloc[:-4].to_list()
