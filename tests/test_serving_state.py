"""ST4, ST5, A10, C6, A9, J1 and X1: retries, replays, racing writers, order, exchange-free joins, users' functions."""

from __future__ import annotations

import os
import threading

import numpy as np
import pandas as pd
import pytest
from conftest import collect_sorted, seasonal_bars, to_bars
from pyspark.sql import functions as F
from test_stream_state import forget_last_commit

import __spark_entry__ as E
from barspark.functions.features import ENGINEERED_V2, Feature, FeatureSet
from barspark.operators import training as train_op
from barspark.operators.features import compute_features
from barspark.plans import scoring
from barspark.plans import training_jobs as jobs
from barspark.sources import bucketed, fsutil, predlog, store
from barspark.streaming.counters import read_totals, stream_totals
from barspark.streaming.sources import bar_stream

FEW = {"n_estimators": 2}


@pytest.fixture(scope="module")
def fitted(spark):
    bars = to_bars(spark, pd.concat([seasonal_bars(160, "AAA", seed=1), seasonal_bars(140, "BBB", seed=2)]))
    rows = train_op.training_frame(bars, ENGINEERED_V2).cache()
    return bars, jobs.fit(rows, ENGINEERED_V2.feature_names, FEW), train_op.training_stats(rows, ENGINEERED_V2.feature_names)


def test_scores_come_from_the_state_and_a_retry_keeps_its_version(spark, tmp_path, fitted):
    bars, model, stats = fitted
    src, scores, log, state, ckpt = (str(tmp_path / n) for n in ("src", "scores", "log", "state", "ckpt"))
    champion, loaded = ["1"], []

    def run():
        scoring.score_stream(bar_stream(spark, src), scores, log, state, ckpt, lambda: champion[0], lambda v: loaded.append(v) or model, stats)
        return collect_sorted(spark.read.parquet(scores).drop("epoch"))

    bars.where("date < '2021-05-01'").write.parquet(src)
    run()
    champion[0] = "2"
    bars.where("date >= '2021-05-01'").write.mode("append").parquet(src)
    first = run()
    champion[0] = "3"  # promoted while the epoch has to be tried again
    forget_last_commit(ckpt)
    again = run()
    pd.testing.assert_frame_equal(first.drop(columns="drifted_features"), again.drop(columns="drifted_features"))
    assert loaded == ["1", "2", "2"]
    ok = again[again["status"] == "ok"]
    assert (ok["model_version"] == np.where(ok["date"] < "2021-05-01", "1", "2")).all()
    assert len(again) == 300 and (again["status"] == "short_history").sum() == 40
    want = jobs.predict(model, compute_features(bars, ENGINEERED_V2))
    np.testing.assert_allclose(ok["probability"], collect_sorted(want)["probability"], rtol=1e-9)
    logged = predlog.read_predictions(spark, log)
    assert logged.count() == 260 and logged.groupBy("ticker", "prediction_date").count().where("count > 1").count() == 0


def test_one_of_two_pins_stays(spark, tmp_path):
    folder = str(tmp_path / "pins")
    assert scoring.pinned_version(spark, folder, 4, lambda: "7") == "7"
    assert scoring.pinned_version(spark, folder, 4, lambda: "8") == "7" and scoring.pinned_version(spark, folder, 5, lambda: "8") == "8"

    def late() -> str:  # another writer pins the epoch while this one resolves it
        fsutil.create_text(spark, fsutil.join(folder, f"epoch-{6:020d}"), "9")
        return "10"

    assert scoring.pinned_version(spark, folder, 6, late) == "9"


def test_serving_requests_pins_the_champion_too(spark, tmp_path, fitted):
    bars, model, _ = fitted
    root, log = str(tmp_path / "root"), str(tmp_path / "log")
    for auc in (0.6, 0.5):
        path = jobs._save(model, root, f"run-{auc}")
        jobs.record_run(spark, root, jobs.RunResult(f"run-{auc}", {"roc_auc": auc}, model_path=path))
    assert jobs.champion(spark, root)["champion_version"] == 1
    assert jobs.load_version(spark, root, "2").stages and pytest.raises(RuntimeError, jobs.load_version, spark, root, "3")
    reqs = str(tmp_path / "req")
    spark.createDataFrame([("AAA",), ("ZZZ",), ("AAA",)], "ticker string").coalesce(1).write.json(reqs)
    stream = spark.readStream.schema("ticker string").json(reqs)
    scoring.serve_stream(stream, lambda s: bars, root, log, str(tmp_path / "ckpt"))
    jobs.record_run(spark, root, jobs.RunResult("run-c", {"roc_auc": 0.9}, model_path=path))
    forget_last_commit(str(tmp_path / "ckpt"))
    scoring.serve_stream(stream, lambda s: bars, root, log, str(tmp_path / "ckpt"))
    assert [r["model_version"] for r in predlog.read_predictions(spark, log).collect()] == ["1", "1"]
    answers = scoring.request_answers(spark.read.schema("ticker string, status string").json(reqs), bars).collect()
    assert sorted(r["status"] for r in answers) == ["ok", "ok", "unknown_ticker"]


@pytest.mark.parametrize("compact", [64, 2, 1])
def test_totals_survive_a_replayed_epoch(spark, tmp_path, compact):
    src, sink, ckpt = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    log = [("A", "UP"), ("A", "UP"), ("B", "DOWN"), (None, "UP")], [("A", "DOWN")], [("A", "UP"), ("B", "DOWN"), (None, "UP")]

    def drain():
        rows = spark.readStream.schema("ticker string, direction string").option("maxFilesPerTrigger", 1).json(src)
        stream_totals(rows, ["ticker", "direction"], "n", sink, ckpt, compact=compact)
        return sorted(((r["ticker"], r["direction"], r["n"]) for r in read_totals(spark, sink, ["ticker", "direction"], "n").collect()), key=str)

    for rows in log:
        spark.createDataFrame(rows, "ticker string, direction string").coalesce(1).write.mode("append").json(src)
        got = drain()
    want = sorted([("A", "UP", 3), ("B", "DOWN", 2), (None, "UP", 2), ("A", "DOWN", 1)], key=str)
    assert got == want
    forget_last_commit(ckpt)
    assert drain() == want
    epochs = [n for n in os.listdir(sink) if n.startswith("epoch=")]
    assert len(epochs) == {64: 3, 2: 2, 1: 1}[compact]


def test_two_writers_never_share_a_run_number(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    assert jobs.record_run(spark, root, jobs.RunResult("a", {"roc_auc": 0.5})) == 1
    numbers = jobs._run_numbers
    # both see run 1 as the newest: the second to write finds its number taken and goes on
    monkeypatch.setattr(jobs, "_run_numbers", lambda s, r: [1])
    assert [jobs.record_run(spark, root, jobs.RunResult(i, {"roc_auc": float("nan")})) for i in "bc"] == [2, 3]
    monkeypatch.setattr(jobs, "_run_numbers", numbers)
    threads = [threading.Thread(target=jobs.record_run, args=(spark, root, jobs.RunResult(f"t{k}", {}))) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    runs = jobs.read_runs(spark, root).collect()
    assert sorted(r["run_seq"] for r in runs) == list(range(1, 10)) and len({r["run_id"] for r in runs}) == 9
    assert [r["roc_auc"] for r in runs if r["run_id"] == "t0"] == [None]


def test_a_taken_name_is_refused_at_the_rename(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "claim")
    fsutil.create_text(spark, path, "first")
    fs, p = fsutil._fs(spark, path)
    other = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(tmp_path / "other"))
    fs.create(other).close()
    assert not fsutil._rename_new(spark, fs, other, p) and fsutil.read_text(spark, path) == "first"


def test_ordered_fingerprint_sees_order_and_not_partitions(spark):
    pdf = seasonal_bars(80, "AAA")
    cols = ["ticker", "date", "close"]

    def digest(frame, partitions=3):
        df = to_bars(spark, frame).repartition(partitions)
        return tuple(train_op.ordered_fingerprint(df, ["ticker", "date"], cols, ["close"], []).first())

    base = digest(pdf)
    assert digest(pdf.sample(frac=1, random_state=1), 7) == base and base[1] == 80
    swapped = pdf.copy()
    swapped.loc[[10, 50], "close"] = pdf.loc[[50, 10], "close"].to_numpy()
    assert digest(swapped) != base
    # the same rows in another order: only the ordered digest tells them apart
    df = to_bars(spark, pdf).withColumn("k", F.dayofmonth("date"))
    two = [train_op.ordered_fingerprint(df, order, cols, ["close"], []).first()["digest"] for order in (["date"], ["k", "date"])]
    assert two[0] != two[1]
    assert train_op.ordered_fingerprint(to_bars(spark, pdf).limit(0), ["date"], cols, ["close"], []).first()["rows"] == 0


def test_bucketed_join_has_no_exchange(spark):
    df = E.queries()["training_set_bucketed"](spark, "/root/testdata/sf0.001")
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_bucketed_set_of_a_hot_ticker_equals_the_joined_one(spark):
    bars = to_bars(spark, pd.concat([seasonal_bars(200, "HOT"), seasonal_bars(30, "COLD", seed=3)]))
    labels = train_op.add_labels(bars)
    feats = compute_features(bars, ENGINEERED_V2)
    names = [bucketed.write_bucketed(t, n, buckets=5) for t, n in ((labels.select("ticker", "date", "label"), "l"), (feats, "f"))]
    got = collect_sorted(bucketed.training_set_bucketed(spark, *names, ENGINEERED_V2))
    pd.testing.assert_frame_equal(got, collect_sorted(train_op.training_set(labels, feats, ENGINEERED_V2)))
    files = spark.table(names[0]).select(F.input_file_name().alias("f")).distinct().count()
    assert files == 5  # the hot ticker lies in all of them


def test_user_functions_online_and_offline(spark):
    spread = lambda pdf: float(np.ptp(pdf["close"]))
    fs = FeatureSet("own", 1, (Feature.from_window("spread", spread, 12), Feature.grouped("ema", lambda p: p["close"].ewm(span=3, adjust=False).mean(), lookback=80)))
    pdf = pd.concat([seasonal_bars(120, "AAA", seed=1), seasonal_bars(11, "BBB", seed=2), seasonal_bars(81, "CCC", seed=5)])
    bars = to_bars(spark, pdf)
    online = store.latest_features(bars, fs).toPandas().set_index("ticker")
    for ticker, own in pdf.groupby("ticker"):
        short = len(own) < 12
        assert np.isnan(online.loc[ticker, "spread"]) if short else online.loc[ticker, "spread"] == pytest.approx(np.ptp(own["close"].tail(12)))
        full = own["close"].ewm(span=3, adjust=False).mean().iloc[-1]
        assert np.isnan(online.loc[ticker, "ema"]) if len(own) < 81 else online.loc[ticker, "ema"] == pytest.approx(full)
    offline = compute_features(bars, fs, chunk_rows=50, dropna=False)
    assert offline.where("spread is null").count() == 33
    parity = {(r["ticker"], r["feature"]): r["same"] for r in store.online_parity(bars, fs).collect()}
    assert parity.pop(("BBB", "ema")) is False  # too few bars online, a value offline
    assert len(parity) == 5 and all(parity.values())
