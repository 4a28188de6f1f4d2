from __future__ import annotations

import pandas as pd
import pytest
from conftest import collect_sorted, seasonal_bars, to_bars
from pyspark.sql import functions as F

from barspark.functions.features import ENGINEERED_V1, ENGINEERED_V2
from barspark.operators.features import compute_features
from barspark.sources import bars as B
from barspark.sources import store as S
from barspark.streaming.features import stream_features
from barspark.streaming.sources import bar_stream, run_available_now
from barspark.streaming.windows import stream_windows


def panel():
    return pd.concat([seasonal_bars(160, "AAA", seed=1), seasonal_bars(140, "BBB", seed=2)])


def test_feature_table_round_trip(spark, tmp_path):
    feats = compute_features(to_bars(spark, panel()), ENGINEERED_V1)
    S.write_features(feats, str(tmp_path), ENGINEERED_V1)
    back = S.read_features(spark, str(tmp_path), ENGINEERED_V1, ["AAA", "BBB"])
    pd.testing.assert_frame_equal(collect_sorted(back), collect_sorted(feats.select(*back.columns)))
    with pytest.raises(FileNotFoundError):
        S.read_features(spark, str(tmp_path), ENGINEERED_V1, ["ZZZ"])


def test_backfill_idempotent_and_range_preserving(spark, tmp_path):
    root = str(tmp_path)
    bars = to_bars(spark, panel())
    S.backfill(spark, bars, ENGINEERED_V1, root, None, None)
    full = collect_sorted(S.read_features(spark, root, ENGINEERED_V1))
    S.backfill(spark, bars, ENGINEERED_V1, root, None, None)
    again = collect_sorted(S.read_features(spark, root, ENGINEERED_V1))
    pd.testing.assert_frame_equal(full, again)
    # a sub-range backfill from changed bars only touches rows in the range
    changed = bars.withColumn("volume", F.col("volume") * 2)
    S.backfill(spark, changed, ENGINEERED_V1, root, "2021-04-01", "2021-04-30")
    after = collect_sorted(S.read_features(spark, root, ENGINEERED_V1))
    inside = (after["date"] >= "2021-04-01") & (after["date"] <= "2021-04-30")
    assert len(after) == len(full)
    pd.testing.assert_frame_equal(after[~inside].reset_index(drop=True), full[~inside.values].reset_index(drop=True))
    assert inside.sum() == 2 * 22
    # twice the volume of every bar leaves the ratio; a jump in one bar's volume changes it
    pd.testing.assert_series_equal(after[inside]["volume_ratio_20d"], full[inside.values]["volume_ratio_20d"])
    jump = F.when(F.col("date") == "2021-04-15", F.col("volume") * 3).otherwise(F.col("volume"))
    S.backfill(spark, bars.withColumn("volume", jump), ENGINEERED_V1, root, "2021-04-01", "2021-04-30")
    third = collect_sorted(S.read_features(spark, root, ENGINEERED_V1))
    moved = third[(third["volume_ratio_20d"] - full["volume_ratio_20d"]).abs() > 1e-9]
    assert set(moved["date"]) == set(full["date"][(full["date"] >= "2021-04-15") & (full["date"] <= "2021-04-30")])


def test_build_then_backfill_share_one_table(spark, tmp_path):
    """All rows outside the backfilled range stay, and every reader sees the merged table."""
    root = str(tmp_path)
    bars = to_bars(spark, panel())
    feats = compute_features(bars, ENGINEERED_V1)
    S.write_features(feats, root, ENGINEERED_V1)
    S.backfill(spark, bars, ENGINEERED_V1, root, "2021-04-01", "2021-04-16")
    S.save_training_stats(spark.createDataFrame([("return_1d", 0.0, 1.0)], "feature string, mean double, std double"), root, ENGINEERED_V1)
    back = collect_sorted(S.read_features(spark, root, ENGINEERED_V1))
    pd.testing.assert_frame_equal(back, collect_sorted(feats)[back.columns])
    assert S.read_features(spark, root, ENGINEERED_V1, ["BBB"]).count() == 120
    # another full build of one ticker keeps the other
    S.write_features(feats.where("ticker = 'AAA'").limit(7), root, ENGINEERED_V1)
    counts = {r["ticker"]: r["count"] for r in S.read_features(spark, root, ENGINEERED_V1).groupBy("ticker").count().collect()}
    assert counts == {"AAA": 7, "BBB": 120}


def test_feature_table_survives_a_crash_between_steps(spark, tmp_path):
    from barspark.sources import fsutil
    from barspark.sources.versions import VersionedTable

    root = str(tmp_path)
    bars = to_bars(spark, panel())
    S.write_features(compute_features(bars, ENGINEERED_V1), root, ENGINEERED_V1)
    table = S.feature_table(spark, root, ENGINEERED_V1)
    # data of a change that never got its manifest is not seen and is removed later
    (tmp_path / ENGINEERED_V1.label / "v-unfinished").mkdir()
    assert S.read_features(spark, root, ENGINEERED_V1).count() == 260
    for _ in range(4):
        S.backfill(spark, bars, ENGINEERED_V1, root, "2021-04-01", "2021-04-16")
    names = fsutil.list_names(spark, table.base)
    assert len(table.numbers()) == 3 and "v-unfinished" not in names
    with pytest.raises(FileExistsError):
        fsutil.create_text(spark, table._path(table.numbers()[-1]), "{}")
    (tmp_path / "half" / "v-1").mkdir(parents=True)
    with pytest.raises(FileNotFoundError, match="did not finish"):
        VersionedTable(spark, str(tmp_path / "half")).folders()


def test_backfill_empty_range_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="without feature rows"):
        S.backfill(spark, to_bars(spark, panel()), ENGINEERED_V1, str(tmp_path), "2030-01-01", "2030-02-01")


def test_upsert_new_wins(spark):
    old = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0)], "ticker string, date int, x double")
    new = spark.createDataFrame([("A", 2, 20.0), ("A", 3, 30.0)], "ticker string, date int, x double")
    got = sorted(tuple(r) for r in S.upsert(old, new).collect())
    assert got == [("A", 1, 1.0), ("A", 2, 20.0), ("A", 3, 30.0)]


def test_tail_and_load(spark, tmp_path):
    bars = to_bars(spark, panel())
    assert S.tail_n(bars, 7).groupBy("ticker").count().where("count = 7").count() == 2
    path = B.write_bars(bars, str(tmp_path / "bars"))
    assert B.load_ticker(spark, path, "AAA").count() == 160
    assert B.load_all(spark, path, ["AAA", "BBB"]).count() == 300
    rows = B.load_all(spark, path, ["BBB", "AAA"], ordered=True).select("ticker", "date").collect()
    assert rows == sorted(rows)
    with pytest.raises(FileNotFoundError):
        B.load_ticker(spark, path, "ZZZ")
    with pytest.raises(FileNotFoundError):
        B.load_all(spark, path, ["AAA", "ZZZ"])


def test_normalize_empty_range_raises(spark):
    raw = to_bars(spark, seasonal_bars(30)).select(
        F.col("ticker").alias("Symbol"), F.col("date").alias("Date"), "open", "high", "low", "close", "volume"
    )
    assert B.normalize_bars(raw, "2021-01-01", "2021-01-08").count() == 4
    with pytest.raises(ValueError, match="has no bars in"):
        B.normalize_bars(raw, "2030-01-01", "2030-02-01")


def test_stream_windows_count_and_late_rows(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    pdf = seasonal_bars(25, "AAPL")
    to_bars(spark, pdf.iloc[:12]).write.parquet(src)
    run_available_now(stream_windows(bar_stream(spark, src), 5), sink, ckpt)
    to_bars(spark, pd.concat([pdf.iloc[12:], pdf.iloc[3:4]])).write.mode("append").parquet(src)  # one late row
    run_available_now(stream_windows(bar_stream(spark, src), 5), sink, ckpt)
    out = spark.read.parquet(sink).toPandas().sort_values("window_end")
    assert len(out) == 21
    assert out["late_rows"].max() == 1
    assert out["close_sum"].iloc[0] == pytest.approx(pdf["close"].iloc[:5].sum())


def test_stream_features_equal_offline(spark, tmp_path):
    src, sink, state, ckpt = (str(tmp_path / n) for n in ("src", "sink", "state", "ckpt"))
    pdf = panel()
    cut = pd.Timestamp("2021-05-01")
    to_bars(spark, pdf[pdf.date < cut]).write.parquet(src)
    stream_features(bar_stream(spark, src), ENGINEERED_V2, sink, state, ckpt)
    to_bars(spark, pdf[pdf.date >= cut]).write.mode("append").parquet(src)
    stream_features(bar_stream(spark, src), ENGINEERED_V2, sink, state, ckpt)
    got = collect_sorted(spark.read.parquet(sink).drop("epoch"))
    want = collect_sorted(compute_features(to_bars(spark, pdf), ENGINEERED_V2))
    pd.testing.assert_frame_equal(got[want.columns], want, rtol=1e-12, atol=1e-12)


def test_stream_features_continue_under_a_new_checkpoint(spark, tmp_path):
    """A lost checkpoint re-reads the source: known rows are counted as late, nothing is lost or doubled."""
    from barspark.streaming.features import late_path

    src, sink, state = (str(tmp_path / n) for n in ("src", "sink", "state"))
    pdf = panel()
    cut = pd.Timestamp("2021-05-03")
    to_bars(spark, pdf[pdf.date < cut]).write.parquet(src)
    stream_features(bar_stream(spark, src), ENGINEERED_V1, sink, state, str(tmp_path / "ckpt1"))
    assert spark.read.parquet(late_path(sink)).count() == 0
    to_bars(spark, pdf[pdf.date >= cut]).write.mode("append").parquet(src)
    stream_features(bar_stream(spark, src), ENGINEERED_V1, sink, state, str(tmp_path / "ckpt2"))
    got = collect_sorted(spark.read.parquet(sink).drop("epoch"))
    want = collect_sorted(compute_features(to_bars(spark, pdf), ENGINEERED_V1))
    pd.testing.assert_frame_equal(got[want.columns], want, rtol=1e-12, atol=1e-12)
    late = spark.read.parquet(late_path(sink)).groupBy().sum("late_rows").first()[0]
    assert late == int((pdf.date < cut).sum())


def test_stream_windows_drop_replayed_rows(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    pdf = seasonal_bars(12, "AAPL")
    to_bars(spark, pdf).write.parquet(src)
    to_bars(spark, pdf.iloc[5:8]).write.mode("append").parquet(src)  # replayed rows in the same batch
    run_available_now(stream_windows(bar_stream(spark, src), 5, dedupe_within="30 days"), sink, ckpt)
    out = spark.read.parquet(sink).toPandas()
    assert len(out) == 8 and out["late_rows"].max() == 0


def test_build_offline_job(spark, tmp_path):
    from barspark.plans.feature_jobs import build_offline

    bars_path = B.write_bars(to_bars(spark, panel()), str(tmp_path / "bars"))
    build_offline(spark, bars_path, str(tmp_path / "feat"), ENGINEERED_V1)
    back = S.read_features(spark, str(tmp_path / "feat"), ENGINEERED_V1)
    assert back.count() == 300 - 2 * 20


def test_month_layout_round_trip_and_pushdown(spark, tmp_path):
    bars = to_bars(spark, panel())
    path = B.write_bars(bars, str(tmp_path / "bars_m"), layout="month")
    back = B.load_ticker(spark, path, "BBB")
    assert back.count() == 140
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ticker), EqualTo(ticker,BBB)]" in plan
    pd.testing.assert_frame_equal(collect_sorted(B.read_bars(spark, path)), collect_sorted(bars))
    odd = to_bars(spark, seasonal_bars(30, "007"))
    p2 = B.write_bars(odd, str(tmp_path / "bars_t"))
    assert B.read_bars(spark, p2).select("ticker").distinct().first()[0] == "007"


def test_scratch_scope_removes_tables_after_a_job(spark, tmp_path):
    from barspark.session import materialize
    from barspark.sources import fsutil

    with fsutil.scratch_scope(spark) as made:
        staged = materialize(to_bars(spark, seasonal_bars(30)), "scoped")
        assert staged.count() == 30 and len(made) == 1 and fsutil.exists(spark, made[0])
    assert not fsutil.exists(spark, made[0])
    # a backfill on the chunked path cleans up its sequence tables
    spark.conf.set("spark.barspark.chunkRows", "64")
    try:
        S.backfill(spark, to_bars(spark, panel()), ENGINEERED_V1, str(tmp_path), None, None)
        assert S.read_features(spark, str(tmp_path), ENGINEERED_V1).count() == 300 - 2 * 20
    finally:
        spark.conf.unset("spark.barspark.chunkRows")


def test_dynamic_overwrite_touches_only_written_tickers(spark, tmp_path):
    path = str(tmp_path / "bars_dyn")
    B.write_bars(to_bars(spark, panel()), path)
    B.write_bars(to_bars(spark, seasonal_bars(10, "AAA", seed=9)), path)  # rewrite AAA only
    counts = {r["ticker"]: r["count"] for r in B.read_bars(spark, path).groupBy("ticker").count().collect()}
    assert counts == {"AAA": 10, "BBB": 140}


def test_stream_windows_can_emit_the_window_rows(spark, tmp_path):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    pdf = seasonal_bars(12, "AAPL")
    to_bars(spark, pdf).write.parquet(src)
    run_available_now(stream_windows(bar_stream(spark, src), 5, emit_rows=True), sink, ckpt)
    out = spark.read.parquet(sink).orderBy("window_end").collect()
    assert len(out) == 8 and all(len(r["rows"]) == 5 for r in out)
    last = out[-1]["rows"]
    assert [r["close"] for r in last] == pytest.approx(pdf["close"].iloc[-5:].tolist())
    assert last[-1]["date"] == out[-1]["window_end"]
