"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator, plus its oracle SQL.

Every query reads the given tables (through the bar adapters) so its work grows with them.
Computed doubles are rounded to 6 places on both sides so the driver's value hash is stable.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.functions.columns import epoch_micros, ratio_change
from barspark.functions.features import (
    ENGINEERED_V1,
    ENGINEERED_V2,
    Feature,
    FeatureSet,
    ema_warmup,
    macd_signal_window_series,
    volatility,
)
from barspark.functions.features import pct_return, rsi, volume_ratio
from barspark.operators import boosting
from barspark.operators import drift as drift_op
from barspark.operators import labels as labels_op
from barspark.operators import metrics as metrics_op
from barspark.operators import performance as perf_op
from barspark.operators import registry as reg_op
from barspark.operators import training as train_op
from barspark.operators.ema_scan import macd_scan
from barspark.operators.features import compute_features, ema_table, window_columns
from barspark.operators.sequence import row_numbers
from barspark.operators.validate import validation_report
from barspark.plans import scoring
from barspark.plans import sql_oracles as O
from barspark.plans import training_jobs as jobs
from barspark.schemas import DATE, PREDICTION_LOG, TICKER
from barspark.sources import bars as bars_src
from barspark.sources import fixtures as fx
from barspark.session import materialize
from barspark.sources import bucketed, fsutil, predlog, store
from barspark.streaming import counters
from barspark.streaming.features import stream_features
from barspark.streaming.sources import bar_stream, run_available_now
from barspark.streaming.windows import stream_windows, stream_windows_chunked

Query = Callable[[SparkSession, str], DataFrame]

SPLIT_DATE = "2024-01-21"


def r6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


def _bars(spark, sf):
    # bars are a stored table in production; stage the derived fixture bars the same way
    return bars_src.stage(fx.bars_events(spark, sf), "bars-events")


def _supplier_bars(spark, sf):
    return bars_src.stage(fx.bars_supplier(spark, sf), "bars-supplier")


# --- windows / features ---------------------------------------------------------------------


def q_features_v1(spark, sf):
    return r6(compute_features(_bars(spark, sf), ENGINEERED_V1), ENGINEERED_V1.feature_names)


def q_features_v2(spark, sf):
    return r6(compute_features(_bars(spark, sf), ENGINEERED_V2), ENGINEERED_V2.feature_names)


def q_features_v1_supplier(spark, sf):
    return r6(compute_features(_supplier_bars(spark, sf), ENGINEERED_V1), ENGINEERED_V1.feature_names)


# The same queries through the hot-key path: every ticker exceeds the chunk size, so rows go
# through range sequence + chunks + halo (V2: two chunks per ticker across the EMA warm-up).
SMALL_CHUNK = 128


def q_features_v1_supplier_chunked(spark, sf):
    out = compute_features(_supplier_bars(spark, sf), ENGINEERED_V1, chunk_rows=SMALL_CHUNK)
    return r6(out, ENGINEERED_V1.feature_names)


def q_features_v2_chunked(spark, sf):
    out = compute_features(_bars(spark, sf), ENGINEERED_V2, chunk_rows=SMALL_CHUNK)
    return r6(out, ENGINEERED_V2.feature_names)


def q_returns(spark, sf):
    cols = {"return_1d": pct_return(1), "return_5d": pct_return(5), "return_20d": pct_return(20)}
    out = window_columns(_bars(spark, sf), cols, back=20, keep=["close"])
    return r6(out, list(cols))


def q_volatility(spark, sf):
    cols = {"volatility_5d": volatility(5), "volatility_20d": volatility(20)}
    return r6(window_columns(_bars(spark, sf), cols, back=20, keep=[]), list(cols))


def q_volume_ratio(spark, sf):
    cols = {"volume_ratio_20d": volume_ratio(20)}
    return r6(window_columns(_bars(spark, sf), cols, back=19, keep=["volume"]), list(cols))


def q_rsi(spark, sf):
    cols = {"rsi_14": rsi(14)}
    return r6(window_columns(_bars(spark, sf), cols, back=14, keep=["close"]), list(cols))


def q_ema(spark, sf):
    return r6(ema_table(_bars(spark, sf)), ["ema_12", "ema_26", "macd", "macd_signal"])


def q_macd_signal(spark, sf):
    out = ema_table(_supplier_bars(spark, sf)).select(TICKER, DATE, "macd_signal")
    return r6(out, ["macd_signal"])


EMA_COLUMNS = ["ema_12", "ema_26", "macd", "macd_signal"]


def q_ema_scan(spark, sf):
    """W5 by the affine scan, in blocks far shorter than any warm-up."""
    return r6(macd_scan(_bars(spark, sf), block_rows=16, fan=8), EMA_COLUMNS)


def q_macd_signal_scan(spark, sf):
    """W6 by the affine scan, every ticker cut into chunks shorter than the EMA warm-up."""
    out = macd_scan(_supplier_bars(spark, sf), chunk_rows=SMALL_CHUNK, block_rows=32)
    return r6(out.select(TICKER, DATE, "macd_signal"), ["macd_signal"])


# W7 for every bar: the closed form (O(1) per row) inside the chunked EMA pass
MACD_WINDOW_SET = FeatureSet(
    "macd_window",
    1,
    (Feature.grouped("macd_signal_window", macd_signal_window_series(100), lookback=ema_warmup(26), required_window=100),),
)


def q_macd_signal_window(spark, sf):
    out = compute_features(_bars(spark, sf), MACD_WINDOW_SET, dropna=False)
    return r6(out, ["macd_signal_window"])


def q_forward_labels(spark, sf):
    return labels_op.add_labels(_bars(spark, sf)).select(TICKER, DATE, "close", "label")


def q_labels_dropped(spark, sf):
    return labels_op.drop_unlabeled(q_forward_labels(spark, sf))


def q_baseline_features(spark, sf):
    return train_op.baseline_features(_bars(spark, sf))


def q_baseline_dataset(spark, sf):
    return train_op.baseline_dataset(_bars(spark, sf))


def q_validate_bars(spark, sf):
    return validation_report(bars_src.stage(fx.bars_events(spark, sf, with_arrival=True), "bars-arrival"), arrival="arrival")


def q_validate_bars_supplier(spark, sf):
    return validation_report(_supplier_bars(spark, sf))


# --- training data --------------------------------------------------------------------------


def _training_set(spark, sf) -> DataFrame:
    """Features and label of one window pass, written once: the queries below read it several times."""
    return materialize(train_op.training_frame(_bars(spark, sf), ENGINEERED_V2), "training")


def q_training_set(spark, sf):
    """Labels joined with the stored feature table."""
    bars, root = _bars(spark, sf), fsutil.scratch(spark, "features")
    store.write_features(compute_features(bars, ENGINEERED_V2), root, ENGINEERED_V2)
    feats = store.read_features(spark, root, ENGINEERED_V2)
    return r6(train_op.training_set(labels_op.add_labels(bars), feats, ENGINEERED_V2), ENGINEERED_V2.feature_names)


def q_training_set_bucketed(spark, sf):
    """J1 of two tables stored in the same buckets: no exchange under the join."""
    bars = _bars(spark, sf)
    labels = bucketed.write_bucketed(labels_op.add_labels(bars).select(TICKER, DATE, "label"), "labels")
    feats = bucketed.write_bucketed(compute_features(bars, ENGINEERED_V2), "features")
    return r6(bucketed.training_set_bucketed(spark, labels, feats, ENGINEERED_V2), ENGINEERED_V2.feature_names)


def q_training_frame(spark, sf):
    return r6(train_op.training_frame(_bars(spark, sf), ENGINEERED_V2), ENGINEERED_V2.feature_names)


def q_training_frame_chunked(spark, sf):
    out = train_op.training_frame(_bars(spark, sf), ENGINEERED_V2, chunk_rows=SMALL_CHUNK)
    return r6(out, ENGINEERED_V2.feature_names)


def q_training_stats_roundtrip(spark, sf):
    """The stats saved and loaded."""
    root = fsutil.scratch(spark, "stats")
    store.save_training_stats(train_op.training_stats(_train(spark, sf), ENGINEERED_V2.feature_names), root, ENGINEERED_V2)
    return r6(store.load_training_stats(spark, root, ENGINEERED_V2), ["mean", "std"])


def q_time_split(spark, sf):
    ts = _training_set(spark, sf)
    return ts.select(TICKER, DATE, "label", labels_op.time_split_column(SPLIT_DATE).alias("split"))


def q_split_counts(spark, sf):
    return train_op.split_counts(_training_set(spark, sf), SPLIT_DATE)


def q_split_date(spark, sf):
    days = spark.read.parquet(f"{sf}/events.parquet").select(F.to_date("ts").alias("run_date")).distinct()
    return days.select(
        F.date_format("run_date", "yyyy-MM-dd").alias("run_date"),
        labels_op.split_date_column(F.col("run_date")).alias("split_date"),
    )


def _train(spark, sf):
    train, _ = labels_op.time_split(_training_set(spark, sf), SPLIT_DATE)
    return train


def q_training_stats(spark, sf):
    return r6(train_op.training_stats(_train(spark, sf), ENGINEERED_V2.feature_names), ["mean", "std"])


def q_fingerprint(spark, sf):
    cols = [TICKER, DATE, "label", *ENGINEERED_V2.feature_names]
    return train_op.fingerprint(_train(spark, sf), cols, ENGINEERED_V2.feature_names, [DATE])


def q_fingerprint_ordered(spark, sf):
    """A9 that depends on the rows' order."""
    cols = [TICKER, DATE, "label", *ENGINEERED_V2.feature_names]
    return train_op.ordered_fingerprint(_train(spark, sf), [TICKER, DATE], cols, ENGINEERED_V2.feature_names, [DATE])


def _drift(spark, sf):
    ts = _training_set(spark, sf)
    train, test = labels_op.time_split(ts, SPLIT_DATE)
    stats = train_op.training_stats(train, ENGINEERED_V2.feature_names)
    return drift_op.drift_flags(test, ENGINEERED_V2.feature_names, stats)


def q_drift_flags(spark, sf):
    d = _drift(spark, sf)
    return d.select(
        TICKER,
        DATE,
        "drift_detected",
        F.array_join("drifted_features", ",").alias("drifted_features"),
        F.size("drifted_features").cast("long").alias("n_drifted"),
    )


def q_drift_events_total(spark, sf):
    return drift_op.drift_events_total(_drift(spark, sf))


# --- monitoring -----------------------------------------------------------------------------


def _log(spark, sf, bars=None):
    bars = bars if bars is not None else _bars(spark, sf)
    return fx.prediction_log(fx.bars_with_returns(bars))


def _evaluated(spark, sf):
    bars = _bars(spark, sf)
    return perf_op.evaluate_predictions(_log(spark, sf, bars), bars)


def q_nearest_bar(spark, sf):
    return _evaluated(spark, sf).select(TICKER, "prediction_date", "model_version", "bar_date")


def q_prediction_status(spark, sf):
    return _evaluated(spark, sf).select(TICKER, "prediction_date", "model_version", "status", "realized")


def q_realized_direction(spark, sf):
    ev = _evaluated(spark, sf).where(F.col("status") == "evaluated")
    return ev.select(TICKER, "prediction_date", "model_version", "bar_date", "close_t", "close_forward", "realized")


def q_prediction_results(spark, sf):
    return perf_op.prediction_results(_evaluated(spark, sf))


def q_prediction_summary(spark, sf):
    return perf_op.prediction_summary(_evaluated(spark, sf))


def q_predictions_total(spark, sf):
    return perf_op.predictions_total(_log(spark, sf))


def q_latency_histogram(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet").select((F.col("value") / 1000.0).alias("latency_seconds"))
    return r6(perf_op.latency_histogram(ev), ["latency_sum"])


# --- metrics --------------------------------------------------------------------------------


def _scored(spark, sf):
    bars = _bars(spark, sf)
    cols = {
        "r1": lambda w: ratio_change(F.col("close"), F.lag("close", 1).over(w)),
        "label": lambda w: labels_op.forward_label(F.col("close"), F.lead("close", 5).over(w)),
    }
    rows = window_columns(bars, cols, back=1, fwd=5, keep=[])
    score = F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-100.0) * F.col("r1"))), 2)
    return rows.where(F.col("r1").isNotNull() & F.col("label").isNotNull()).select(
        TICKER, DATE, "label", score.alias("score"), (score >= 0.5).cast("int").alias("prediction")
    )


def q_roc_auc(spark, sf):
    return r6(metrics_op.roc_auc(_scored(spark, sf)), ["roc_auc"])


def q_roc_auc_by_ticker(spark, sf):
    return r6(metrics_op.roc_auc(_scored(spark, sf), keys=[TICKER]), ["roc_auc"])


def q_classification_metrics(spark, sf):
    cols = ["accuracy", "precision_class1", "recall_class1", "f1_class1", "label_balance", "roc_auc"]
    return r6(metrics_op.classification_metrics(_scored(spark, sf)), cols)


# --- registry -------------------------------------------------------------------------------


def _runs(spark, sf):
    return fx.runs_from_events(spark.read.parquet(f"{sf}/events.parquet"))


def q_run_versions(spark, sf):
    return reg_op.run_versions(_runs(spark, sf)).select(
        "model", "run_id", "run_seq", F.col("version").cast("long").alias("version")
    )


def q_promotion_history(spark, sf):
    h = reg_op.promotion_history(_runs(spark, sf))
    return r6(
        h.select(
            "model",
            "run_id",
            "run_seq",
            F.col("version").cast("long").alias("version"),
            "roc_auc",
            "promoted",
            F.col("champion_version").cast("long").alias("champion_version"),
            "champion_auc",
        ),
        ["roc_auc", "champion_auc"],
    )


def q_alias_history(spark, sf):
    a = reg_op.alias_history(reg_op.promotion_history(_runs(spark, sf)))
    return a.withColumn("version", F.col("version").cast("long"))


def q_current_champion(spark, sf):
    c = reg_op.current_champion(reg_op.promotion_history(_runs(spark, sf)))
    return c.withColumn("champion_version", F.col("champion_version").cast("long"))


def q_champion_metrics(spark, sf):
    runs = _runs(spark, sf)
    m = reg_op.champion_metrics(reg_op.promotion_history(runs), runs)
    return r6(m.withColumn("champion_version", F.col("champion_version").cast("long")), ["roc_auc"])



# --- sources, store, serving, streaming, learning -------------------------------------------

BACKFILL_START, BACKFILL_END = "2024-01-10", "2024-01-20"
UPSERT_OLD_END, UPSERT_START, UPSERT_END = "2024-01-18", "2024-01-15", "2024-01-25"
LOAD_ONE, LOAD_MANY = "click", ["click", "signup", "view"]
NORMALIZE_START, NORMALIZE_END = "2024-01-05", "2024-01-25"
STREAM_SPLIT = "2024-01-16"
WINDOW_SIZE = 5


def q_tail_n(spark, sf):
    return store.tail_n(_bars(spark, sf), 100).select(TICKER, DATE, "close")


def q_latest_features(spark, sf):
    return r6(store.latest_features(_bars(spark, sf), ENGINEERED_V2), ENGINEERED_V2.feature_names)


def _range_position(pdf):
    """Where the last close lies between the lowest low and the highest high of the bars."""
    low, high = pdf["low"].min(), pdf["high"].max()
    return (pdf["close"].iloc[-1] - low) / (high - low)


USER_SET = FeatureSet(
    "user",
    1,
    (
        Feature("return_1d", pct_return(1), required_window=2, lookback=1),
        Feature.from_window("median_15", lambda pdf: pdf["close"].median(), 15),
        Feature.from_window("range_position_30", _range_position, 30),
        Feature.grouped("spread_sum_10", lambda pdf: (pdf["high"] - pdf["low"]).rolling(10).sum(), lookback=9),
    ),
)


def q_latest_features_grouped(spark, sf):
    """X1 online: users' functions called on each ticker's last bars, beside a Column feature."""
    return r6(store.latest_features(_bars(spark, sf), USER_SET), USER_SET.feature_names)


def q_online_parity(spark, sf):
    """X1's check: online and offline values of the last bars agree."""
    return store.online_parity(_bars(spark, sf), USER_SET).select(TICKER, "feature", "same")


def q_backfill_range(spark, sf):
    out = store.backfill_slice(_bars(spark, sf), ENGINEERED_V1, BACKFILL_START, BACKFILL_END)
    return r6(out, ENGINEERED_V1.feature_names)


def q_backfill_upsert(spark, sf):
    bars = _bars(spark, sf)
    existing = compute_features(bars.where(F.col(DATE) < F.to_timestamp_ntz(F.lit(UPSERT_OLD_END))), ENGINEERED_V1)
    new = store.backfill_slice(bars, ENGINEERED_V1, UPSERT_START, UPSERT_END)
    return r6(store.upsert(existing, new), ENGINEERED_V1.feature_names)


def q_feature_store_roundtrip(spark, sf):
    """The feature table written and read back."""
    root = fsutil.scratch(spark, "features")
    store.write_features(compute_features(_bars(spark, sf), ENGINEERED_V1), root, ENGINEERED_V1)
    return r6(store.read_features(spark, root, ENGINEERED_V1), ENGINEERED_V1.feature_names)


def q_backfill_store(spark, sf):
    """U2 end to end: a table built from the older bars, backfilled from all bars, and read."""
    bars, root = _bars(spark, sf), fsutil.scratch(spark, "features")
    older = bars.where(F.col(DATE) < F.to_timestamp_ntz(F.lit(UPSERT_OLD_END)))
    store.write_features(compute_features(older, ENGINEERED_V1), root, ENGINEERED_V1)
    store.backfill(spark, bars, ENGINEERED_V1, root, UPSERT_START, UPSERT_END)
    return r6(store.read_features(spark, root, ENGINEERED_V1), ENGINEERED_V1.feature_names)


def q_forward_labels_chunked(spark, sf):
    return labels_op.add_labels(_bars(spark, sf), chunk_rows=SMALL_CHUNK).select(TICKER, DATE, "close", "label")


def q_score_unknown_tickers(spark, sf):
    bars = _bars(spark, sf)
    return scoring.request_status(_log(spark, sf, bars), bars)


def q_request_answers(spark, sf):
    """J5 with an answer to every row of the prediction log."""
    bars = _bars(spark, sf)
    return scoring.request_answers(_log(spark, sf, bars), bars).select(TICKER, "prediction_date", "model_version", "status", "latest_bar")


def _sliding_columns(size: int):
    def frame(w):
        return w.rowsBetween(-(size - 1), 0)

    return {
        "window_start": lambda w: F.first(DATE).over(frame(w)),
        "n_rows": lambda w: F.count(F.lit(1)).over(frame(w)),
        "close_first": lambda w: F.first("close").over(frame(w)),
        "close_last": lambda w: F.col("close"),
        "close_sum": lambda w: F.sum("close").over(frame(w)),
    }


def q_sliding_windows(spark, sf):
    rows = window_columns(_bars(spark, sf), _sliding_columns(WINDOW_SIZE), back=WINDOW_SIZE - 1, keep=[])
    out = rows.where(F.col("n_rows") == WINDOW_SIZE).withColumnRenamed(DATE, "window_end")
    return r6(out, ["close_sum"])


def q_normalize_bars(spark, sf):
    bars = _bars(spark, sf)
    # vendor-style zoned timestamps: the instant whose New York wall clock is the bar date
    session_tz = spark.conf.get("spark.sql.session.timeZone")
    instant = F.convert_timezone(F.lit("America/New_York"), F.lit(session_tz), F.col(DATE)).cast("timestamp")
    raw = bars.select(
        F.col(TICKER).alias("Symbol"),
        instant.alias("Date"),
        F.col("open").alias("Open"),
        F.col("high").alias("High"),
        F.col("low").alias("Low"),
        F.col("close").alias("Close"),
        F.col("volume").alias("Volume"),
        F.lit(0.0).alias("Dividends"),
        F.lit(0.0).alias("Stock Splits"),
    )
    return bars_src.normalize_bars(raw, NORMALIZE_START, NORMALIZE_END)


def _written_bars(spark, sf) -> str:
    return bars_src.write_bars(_bars(spark, sf), fsutil.scratch(spark, "bars"))


def q_load_ticker(spark, sf):
    return bars_src.load_ticker(spark, _written_bars(spark, sf), LOAD_ONE)


def q_load_all(spark, sf):
    return bars_src.load_all(spark, _written_bars(spark, sf), LOAD_MANY)


def q_ordered_bars(spark, sf):
    """Several tickers in (ticker, date) order, numbered as they come."""
    ordered = bars_src.load_all(spark, _written_bars(spark, sf), LOAD_MANY, ordered=True)
    return row_numbers(ordered).select("row_no", TICKER, DATE, "close")


def q_merged_order(spark, sf):
    """Old and new rows merged, sorted and numbered."""
    bars = _bars(spark, sf)
    old = bars.where(F.col(DATE) < F.to_timestamp_ntz(F.lit(UPSERT_OLD_END))).withColumn("close", F.col("close") + 1000)
    merged = store.upsert(old, bars.where(F.col(DATE) >= F.to_timestamp_ntz(F.lit(UPSERT_START))))
    return row_numbers(merged.orderBy(TICKER, DATE)).select("row_no", TICKER, DATE, "close")


def q_log_timestamps(spark, sf):
    """F8: every logged row has a UTC timestamp between the clock before the append and after it."""
    path = fsutil.scratch(spark, "predlog")
    began = dt.datetime.now(dt.timezone.utc).isoformat()
    predlog.append_predictions(_log(spark, sf), path)
    ended = dt.datetime.now(dt.timezone.utc).isoformat()
    at = F.col("timestamp")
    fits = at.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$") & at.between(began, ended)
    return predlog.read_predictions(spark, path).groupBy(TICKER).agg(F.count("*").alias("rows"), F.bool_and(fits).alias("in_interval"))


def q_prediction_log_roundtrip(spark, sf):
    path = fsutil.scratch(spark, "predlog")
    predlog.append_predictions(_log(spark, sf), path)
    return predlog.read_predictions(spark, path).drop("timestamp")


def _two_part_bar_files(spark, sf) -> str:
    """Bar files arriving in two appends (before / from the split), like a live feed."""
    path = fsutil.scratch(spark, "bar-stream")
    bars = _bars(spark, sf)
    cut = F.to_timestamp_ntz(F.lit(STREAM_SPLIT))
    bars.where(F.col(DATE) < cut).write.mode("append").parquet(path)
    return path, bars.where(F.col(DATE) >= cut)


def q_stream_rows(spark, sf):
    src, rest = _two_part_bar_files(spark, sf)
    sink, ckpt = fsutil.scratch(spark, "rows-sink"), fsutil.scratch(spark, "rows-ckpt")
    run_available_now(bar_stream(spark, src), sink, ckpt)
    rest.write.mode("append").parquet(src)
    run_available_now(bar_stream(spark, src), sink, ckpt)
    return spark.read.parquet(sink)


def q_stream_windows(spark, sf):
    src, rest = _two_part_bar_files(spark, sf)
    sink, ckpt = fsutil.scratch(spark, "win-sink"), fsutil.scratch(spark, "win-ckpt")
    run_available_now(stream_windows(bar_stream(spark, src), WINDOW_SIZE), sink, ckpt)
    rest.write.mode("append").parquet(src)
    run_available_now(stream_windows(bar_stream(spark, src), WINDOW_SIZE), sink, ckpt)
    return r6(spark.read.parquet(sink), ["close_sum"])


def q_stream_windows_chunked(spark, sf):
    """ST2 with every ticker's bars of a micro-batch cut into chunks of 16."""
    src, rest = _two_part_bar_files(spark, sf)
    sink, ckpt = fsutil.scratch(spark, "hotwin-sink"), fsutil.scratch(spark, "hotwin-ckpt")
    stream_windows_chunked(bar_stream(spark, src), WINDOW_SIZE, sink, ckpt, chunk_rows=16)
    rest.write.mode("append").parquet(src)
    stream_windows_chunked(bar_stream(spark, src), WINDOW_SIZE, sink, ckpt, chunk_rows=16)
    return r6(spark.read.parquet(sink).drop("epoch"), ["close_sum"])


STREAM_CUTS = ["2024-01-09", STREAM_SPLIT, "2024-01-23"]


def _bars_between(bars, start, end):
    """Bars from ``start`` up to, not with, ``end`` (either may be open)."""
    at = [F.to_timestamp_ntz(F.lit(d)) if d else None for d in (start, end)]
    rows = bars if at[0] is None else bars.where(F.col(DATE) >= at[0])
    return rows if at[1] is None else rows.where(F.col(DATE) < at[1])


def q_stream_features(spark, sf):
    """ST3 over four arrivals, each a micro-batch of its own."""
    bars, src = _bars(spark, sf), fsutil.scratch(spark, "bar-stream")
    sink, state, ckpt = (fsutil.scratch(spark, n) for n in ("feat-sink", "feat-state", "feat-ckpt"))
    for start, end in zip([None, *STREAM_CUTS], [*STREAM_CUTS, None]):
        _bars_between(bars, start, end).write.mode("append").parquet(src)
        stream_features(bar_stream(spark, src), ENGINEERED_V2, sink, state, ckpt)
    out = spark.read.parquet(sink).drop("epoch")
    return r6(out, ENGINEERED_V2.feature_names)


FEW_TREES = {"n_estimators": 5}


def _scored_stream(spark, sf, bars, resolve, between=lambda: None) -> tuple[str, str]:
    """ST4 over two arrivals, ``between()`` them, with a small model: (scores, prediction log)."""
    train = _train(spark, sf)
    model = jobs.fit(train, ENGINEERED_V2.feature_names, FEW_TREES)
    stats = train_op.training_stats(train, ENGINEERED_V2.feature_names)
    src, scores, log, state, ckpt = (fsutil.scratch(spark, n) for n in ("bar-stream", "scores", "log", "score-state", "score-ckpt"))
    for start, end in ((None, STREAM_SPLIT), (STREAM_SPLIT, None)):
        _bars_between(bars, start, end).write.mode("append").parquet(src)
        scoring.score_stream(bar_stream(spark, src), scores, log, state, ckpt, resolve, lambda version: model, stats)
        if end:
            between()
    return scores, log


def q_stream_scores(spark, sf):
    """ST4: every bar scored from the stream's state; ``logged``: its prediction stands in the log."""
    scores, log = _scored_stream(spark, sf, _bars(spark, sf), lambda: "1")
    named = spark.read.parquet(scores).withColumn("prediction_date", F.date_format(DATE, "yyyy-MM-dd HH:mm:ss"))
    keys = [TICKER, "prediction_date", "direction", "model_version"]
    logged = predlog.read_predictions(spark, log).groupBy(*keys).agg(F.count(F.lit(1)).alias("entries"))
    ok = F.col("status") == "ok"
    return named.join(logged, keys, "left").select(
        TICKER, DATE, "status", "drift_detected", F.array_join("drifted_features", ",").alias("drifted_features"), "model_version",
        F.coalesce(F.col("entries"), F.lit(0)).alias("logged"), F.when(ok, _in_unit("probability")).alias("in_range"),
    )


REGISTRY_MODEL, REGISTRY_CUT = "purchase", "2024-01-02"


def q_stream_champions(spark, sf):
    """ST5: the version that scored each bar; runs registered between two epochs move the champion."""
    runs = materialize(_runs(spark, sf).where(F.col("model") == REGISTRY_MODEL), "registry-runs")
    table = fsutil.scratch(spark, "registry")
    early = F.col("run_seq") <= F.unix_date(F.lit(REGISTRY_CUT).cast("date"))
    runs.where(early).write.parquet(table)

    def resolve() -> str:
        history = reg_op.promotion_history(spark.read.schema(runs.schema).parquet(table))
        return str(reg_op.current_champion(history).first()["champion_version"])

    scores, _ = _scored_stream(spark, sf, _bars(spark, sf), resolve, lambda: runs.where(~early).write.mode("append").parquet(table))
    return spark.read.parquet(scores).where("status = 'ok'").select(TICKER, DATE, "model_version")


def _in_three_files(df: DataFrame, by, name: str) -> str:
    """Rows as JSON files that arrive one after the other."""
    path = fsutil.scratch(df.sparkSession, name)
    part = F.pmod(F.xxhash64(by), F.lit(3))
    for k in range(3):
        df.where(part == k).coalesce(1).write.mode("append").json(path)
    return path


def q_predictions_total_stream(spark, sf):
    """A10 as a running counter over a growing prediction log."""
    src = _in_three_files(materialize(_log(spark, sf), "log"), F.col("prediction_date"), "log-stream")
    sink, ckpt = fsutil.scratch(spark, "totals"), fsutil.scratch(spark, "totals-ckpt")
    log = spark.readStream.schema(PREDICTION_LOG).option("maxFilesPerTrigger", 1).json(src)
    counters.stream_totals(log, [TICKER, "direction"], "predictions_total", sink, ckpt)
    return counters.read_totals(spark, sink, [TICKER, "direction"], "predictions_total")


def q_drift_events_total_stream(spark, sf):
    """A11 as a running counter over rows with drift flags."""
    flags = materialize(_drift(spark, sf).select(TICKER, DATE, "drift_detected"), "flags")
    src = _in_three_files(flags, F.col(DATE), "flag-stream")
    sink, ckpt = fsutil.scratch(spark, "totals"), fsutil.scratch(spark, "totals-ckpt")
    rows = spark.readStream.schema(flags.schema).option("maxFilesPerTrigger", 1).json(src)
    counters.stream_totals(rows, [TICKER], "drift_events_total", sink, ckpt, where=F.col("drift_detected"))
    return counters.read_totals(spark, sink, [TICKER], "drift_events_total")


# The model's scores are MLlib's own.  Each job has two queries: one returns its scores or metrics as they are (no
# oracle), one what can be worked out exactly (rows, counts, balance, fingerprint, split) and whether the scores
# lie where they must.


def _fitted(spark, sf):
    train, test = labels_op.time_split(_training_set(spark, sf), SPLIT_DATE)
    return jobs.fit(train, ENGINEERED_V2.feature_names), test


#: The first trees, in bins of equal width (whose edges SQL can work out as well).
FIRST_TREES = boosting.BoostParams(trees=3, depth=3, bins=16)


def _boosted(spark, sf):
    train, test = labels_op.time_split(r6(_training_set(spark, sf), ENGINEERED_V2.feature_names), SPLIT_DATE)
    names = ENGINEERED_V2.feature_names
    edges = boosting.even_edges(train, names, FIRST_TREES.bins)
    key = F.concat_ws("|", TICKER, epoch_micros(F.col(DATE)).cast("string"))
    return boosting.fit_boosted(train, names, key, FIRST_TREES, test, edges=edges)


def q_boosted_nodes(spark, sf):
    """M1, second order: cuts, gains and weights of the first trees."""
    return r6(_boosted(spark, sf).table(spark).drop("threshold"), ["gain", "hessian", "weight"])


def q_boosted_rounds(spark, sf):
    """M1: the test rows' log loss after each tree."""
    return r6(_boosted(spark, sf).rounds(spark), ["log_loss"])


def _in_unit(*cols: str):
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.coalesce(F.col(c).between(0, 1), F.lit(False))
    return ok


def q_gbt_metric_values(spark, sf):
    """M3: all metrics of the fitted model on the test rows."""
    model, test = _fitted(spark, sf)
    return jobs.evaluate(model, test)


def q_gbt_metrics(spark, sf):
    m = q_gbt_metric_values(spark, sf)
    names = ("accuracy", "precision_class1", "recall_class1", "f1_class1", "roc_auc")
    return m.select(F.round("label_balance", 6).alias("label_balance"), _in_unit(*names).alias("in_range"))


def q_batch_prediction_scores(spark, sf):
    """M2: class and probability of every test row, beside its label."""
    model, test = _fitted(spark, sf)
    return jobs.predict(model, test).select(TICKER, DATE, "label", "prediction", "probability")


def q_batch_predictions(spark, sf):
    scored = q_batch_prediction_scores(spark, sf)
    fits = (F.col("prediction") == (F.col("probability") > 0.5).cast("int")) & _in_unit("probability")
    return scored.select(TICKER, DATE, fits.alias("in_range"))


RUN_METRICS = ("accuracy", "roc_auc", "f1_class1")


def _run_rows(spark, root, model: str) -> DataFrame:
    """The stored runs of a model: logged parameters and metrics."""
    runs = jobs.read_runs(spark, root).where(F.col("model") == model)
    m = F.col("metrics")
    return runs.select(
        "run_seq",
        F.round(m["label_balance"], 6).alias("label_balance"),
        F.col("params")["test_split_date"].alias("test_split_date"),
        F.col("params")["feature_columns"].alias("feature_columns"),
        F.col("params")["train_data_fingerprint"].alias("train_data_fingerprint"),
        F.col("params")["train_rows"].alias("train_rows"),
        F.col("params")["test_rows"].alias("test_rows"),
        F.col("params")["n_estimators"].alias("n_estimators"),
        *[m[n].alias(n) for n in RUN_METRICS],
    )


def _checkable(runs: DataFrame) -> DataFrame:
    return runs.withColumn("in_range", _in_unit(*RUN_METRICS)).drop(*RUN_METRICS)


def q_baseline_run_metrics(spark, sf):
    root = fsutil.scratch(spark, "runs")
    jobs.run_baseline(spark, _bars(spark, sf), root, SPLIT_DATE)
    return _run_rows(spark, root, jobs.BASELINE_MODEL_NAME).drop("train_data_fingerprint", "train_rows", "test_rows")


def q_baseline_run(spark, sf):
    return _checkable(q_baseline_run_metrics(spark, sf))


def q_engineered_run_metrics(spark, sf):
    root = fsutil.scratch(spark, "runs")
    jobs.run_engineered(spark, _bars(spark, sf), root, SPLIT_DATE)
    return _run_rows(spark, root, jobs.MODEL_NAME)


def q_engineered_run(spark, sf):
    return _checkable(q_engineered_run_metrics(spark, sf))


def q_run_log(spark, sf):
    """The logged parameters of both jobs, as numbered records (few trees: the parameters don't depend on them)."""
    root, bars = fsutil.scratch(spark, "runs"), _bars(spark, sf)
    jobs.run_baseline(spark, bars, root, SPLIT_DATE, params=FEW_TREES)
    jobs.run_engineered(spark, bars, root, SPLIT_DATE, params=FEW_TREES)
    names = ["tickers", "feature_columns", "test_split_date", "train_rows", "test_rows", *jobs.GBT_PARAMS]
    names += ["feature_set", "feature_set_version", "train_data_fingerprint"]
    return jobs.read_runs(spark, root).select("run_seq", "model", "dry_run", *[F.col("params")[n].alias(n) for n in names])


CHAMPION_RUNS = ("2024-04-20", "2024-04-25")


def _champion_scored(spark, sf) -> tuple[DataFrame, DataFrame]:
    """M6 twice (the second may or may not be promoted) -> C4 champion -> J5 + D1 scoring of the prediction log,
    each of its rows a request: (responses, errors)."""
    bars, root = _bars(spark, sf), fsutil.scratch(spark, "registry")
    for run_date in CHAMPION_RUNS:
        jobs.run_dated(spark, bars, root, run_date)
    model, version = jobs.load_champion(spark, root)
    stats = store.load_training_stats(spark, root, ENGINEERED_V2)
    return scoring.score_requests(_log(spark, sf, bars), bars, model, version, stats)


def q_champion_scores(spark, sf):
    """Every row of the prediction log as a request, with its own columns, its status and its scores (no oracle)."""
    out, errors = _champion_scored(spark, sf)
    answered = out.drop(*ENGINEERED_V2.feature_names, "feature_set").withColumn("status", F.lit("ok"))
    return answered.unionByName(errors, allowMissingColumns=True)


def q_champion_scoring(spark, sf):
    """The same requests by ticker, as far as can be worked out exactly: each requested ticker once, answered or
    refused, and whether the scores of all its requests lie where they must."""
    out, errors = _champion_scored(spark, sf)
    fits = _in_unit("probability") & F.col("direction").isin("UP", "DOWN") & F.col("model_version").isin("1", "2")
    fits = F.coalesce(fits & F.col("drift_detected").isNotNull(), F.lit(False))
    answered = out.groupBy(TICKER, F.lit("ok").alias("status"), "prediction_date").agg(F.bool_and(fits).alias("in_range"))
    refused = errors.select(TICKER, "status").distinct()
    return answered.unionByName(refused, allowMissingColumns=True)


QUERIES: dict[str, Query] = {
    "features_v1": q_features_v1,
    "features_v2": q_features_v2,
    "features_v1_supplier": q_features_v1_supplier,
    "features_v1_supplier_chunked": q_features_v1_supplier_chunked,
    "features_v2_chunked": q_features_v2_chunked,
    "returns": q_returns,
    "volatility": q_volatility,
    "volume_ratio": q_volume_ratio,
    "rsi": q_rsi,
    "ema": q_ema,
    "macd_signal": q_macd_signal,
    "macd_signal_window": q_macd_signal_window,
    "ema_scan": q_ema_scan,
    "macd_signal_scan": q_macd_signal_scan,
    "forward_labels": q_forward_labels,
    "labels_dropped": q_labels_dropped,
    "baseline_features": q_baseline_features,
    "baseline_dataset": q_baseline_dataset,
    "validate_bars": q_validate_bars,
    "validate_bars_supplier": q_validate_bars_supplier,
    "training_set": q_training_set,
    "training_set_bucketed": q_training_set_bucketed,
    "training_frame": q_training_frame,
    "training_frame_chunked": q_training_frame_chunked,
    "training_stats_roundtrip": q_training_stats_roundtrip,
    "forward_labels_chunked": q_forward_labels_chunked,
    "feature_store_roundtrip": q_feature_store_roundtrip,
    "backfill_store": q_backfill_store,
    "time_split": q_time_split,
    "split_counts": q_split_counts,
    "split_date": q_split_date,
    "training_stats": q_training_stats,
    "fingerprint": q_fingerprint,
    "fingerprint_ordered": q_fingerprint_ordered,
    "drift_flags": q_drift_flags,
    "drift_events_total": q_drift_events_total,
    "nearest_bar": q_nearest_bar,
    "prediction_status": q_prediction_status,
    "realized_direction": q_realized_direction,
    "prediction_results": q_prediction_results,
    "prediction_summary": q_prediction_summary,
    "predictions_total": q_predictions_total,
    "latency_histogram": q_latency_histogram,
    "roc_auc": q_roc_auc,
    "roc_auc_by_ticker": q_roc_auc_by_ticker,
    "classification_metrics": q_classification_metrics,
    "run_versions": q_run_versions,
    "promotion_history": q_promotion_history,
    "alias_history": q_alias_history,
    "current_champion": q_current_champion,
    "champion_metrics": q_champion_metrics,
    "tail_n": q_tail_n,
    "latest_features": q_latest_features,
    "latest_features_grouped": q_latest_features_grouped,
    "online_parity": q_online_parity,
    "backfill_range": q_backfill_range,
    "backfill_upsert": q_backfill_upsert,
    "score_unknown_tickers": q_score_unknown_tickers,
    "request_answers": q_request_answers,
    "sliding_windows": q_sliding_windows,
    "normalize_bars": q_normalize_bars,
    "load_ticker": q_load_ticker,
    "load_all": q_load_all,
    "ordered_bars": q_ordered_bars,
    "merged_order": q_merged_order,
    "log_timestamps": q_log_timestamps,
    "prediction_log_roundtrip": q_prediction_log_roundtrip,
    "stream_rows": q_stream_rows,
    "stream_windows": q_stream_windows,
    "stream_windows_chunked": q_stream_windows_chunked,
    "stream_features": q_stream_features,
    "stream_scores": q_stream_scores,
    "stream_champions": q_stream_champions,
    "predictions_total_stream": q_predictions_total_stream,
    "drift_events_total_stream": q_drift_events_total_stream,
    "boosted_nodes": q_boosted_nodes,
    "boosted_rounds": q_boosted_rounds,
    "gbt_metrics": q_gbt_metrics,
    "gbt_metric_values": q_gbt_metric_values,
    "batch_predictions": q_batch_predictions,
    "batch_prediction_scores": q_batch_prediction_scores,
    "baseline_run": q_baseline_run,
    "baseline_run_metrics": q_baseline_run_metrics,
    "engineered_run": q_engineered_run,
    "engineered_run_metrics": q_engineered_run_metrics,
    "champion_scoring": q_champion_scoring,
    "run_log": q_run_log,
    "champion_scores": q_champion_scores,
}


def _v(cols):
    return ", ".join(cols)


V1, V2 = O.V1, O.V2

ORACLES: dict[str, str] = {
    "features_v1": f"WITH {O.BARS},{O.window_features()} SELECT ticker, date, {O.r6(V1)} FROM wf WHERE {O.not_null(V1)}",
    "features_v2": f"WITH RECURSIVE {O.BARS},{O.window_features()},{O.ema_recursive()},{O.FEATURES_V2_TABLE} "
    f"SELECT ticker, date, {O.r6(V2)} FROM fv2",
    "features_v1_supplier": f"WITH {O.SBARS},{O.window_features('sbars')} SELECT ticker, date, {O.r6(V1)} FROM wf WHERE {O.not_null(V1)}",
    "features_v1_supplier_chunked": f"WITH {O.SBARS},{O.window_features('sbars')} SELECT ticker, date, {O.r6(V1)} FROM wf WHERE {O.not_null(V1)}",
    "features_v2_chunked": f"WITH RECURSIVE {O.BARS},{O.window_features()},{O.ema_recursive()},{O.FEATURES_V2_TABLE} "
    f"SELECT ticker, date, {O.r6(V2)} FROM fv2",
    "returns": f"WITH {O.BARS},{O.window_features()} SELECT ticker, date, close, {O.r6(['return_1d', 'return_5d', 'return_20d'])} FROM wf",
    "volatility": f"WITH {O.BARS},{O.window_features()} SELECT ticker, date, {O.r6(['volatility_5d', 'volatility_20d'])} FROM wf",
    "volume_ratio": f"WITH {O.BARS},{O.window_features()} SELECT ticker, date, volume, {O.r6(['volume_ratio_20d'])} FROM wf",
    "rsi": f"WITH {O.BARS},{O.window_features()} SELECT ticker, date, close, {O.r6(['rsi_14'])} FROM wf",
    "ema": f"WITH RECURSIVE {O.BARS},{O.ema_recursive()} SELECT ticker, date, close, {O.r6(['ema_12', 'ema_26', 'macd', 'macd_signal'])} FROM em",
    "macd_signal": f"WITH RECURSIVE {O.SBARS},{O.ema_recursive('sbars')} SELECT ticker, date, {O.r6(['macd_signal'])} FROM em",
    "macd_signal_window": f"WITH RECURSIVE {O.BARS},{O.ema_window_recursive()} SELECT ticker, date, {O.r6(['macd_signal_window'])} FROM mw",
    "forward_labels": f"WITH {O.BARS},{O.labels()} SELECT ticker, date, close, label FROM lb",
    "labels_dropped": f"WITH {O.BARS},{O.labels()} SELECT ticker, date, close, label FROM lb WHERE label IS NOT NULL",
    "baseline_features": f"WITH {O.BARS} SELECT ticker, date, open, high, low, close, volume FROM bars",
    "baseline_dataset": f"WITH {O.BARS},{O.labels()} SELECT ticker, date, label, open, high, low, close, volume FROM lb WHERE label IS NOT NULL",
    "validate_bars": f"""WITH {O.BARS},
u AS (SELECT ticker, CAST(coalesce(sum(back), 0) AS BIGINT) AS unsorted_dates
       FROM (SELECT ticker, CASE WHEN lag(date) OVER (PARTITION BY ticker ORDER BY arrival) > date THEN 1 ELSE 0 END AS back FROM bars)
       GROUP BY ticker),
c AS (SELECT ticker, count(*) AS n_rows,
  count(*) FILTER (WHERE open IS NULL OR isnan(open)) AS null_open, count(*) FILTER (WHERE high IS NULL OR isnan(high)) AS null_high,
  count(*) FILTER (WHERE low IS NULL OR isnan(low)) AS null_low, count(*) FILTER (WHERE close IS NULL OR isnan(close)) AS null_close,
  count(*) FILTER (WHERE volume IS NULL OR isnan(volume)) AS null_volume,
  count(*) FILTER (WHERE close <= 0) AS non_positive_close, count(*) FILTER (WHERE volume < 0) AS negative_volume,
  count(date) - count(DISTINCT date) AS repeated_dates
  FROM bars GROUP BY ticker)
SELECT c.*, u.unsorted_dates, CASE WHEN n_rows < 100 THEN 'too_few_rows'
  WHEN null_open + null_high + null_low + null_close + null_volume > 0 THEN 'null_values'
  WHEN non_positive_close > 0 THEN 'non_positive_close' WHEN negative_volume > 0 THEN 'negative_volume'
  WHEN u.unsorted_dates > 0 THEN 'unsorted_dates' END AS first_violation
FROM c JOIN u USING (ticker)""",
    "validate_bars_supplier": f"""WITH {O.SBARS}
SELECT ticker, count(*) AS n_rows,
  count(*) FILTER (WHERE open IS NULL OR isnan(open)) AS null_open, count(*) FILTER (WHERE high IS NULL OR isnan(high)) AS null_high,
  count(*) FILTER (WHERE low IS NULL OR isnan(low)) AS null_low, count(*) FILTER (WHERE close IS NULL OR isnan(close)) AS null_close,
  count(*) FILTER (WHERE volume IS NULL OR isnan(volume)) AS null_volume,
  count(*) FILTER (WHERE close <= 0) AS non_positive_close, count(*) FILTER (WHERE volume < 0) AS negative_volume,
  count(date) - count(DISTINCT date) AS repeated_dates, CAST(0 AS BIGINT) AS unsorted_dates,
  CASE WHEN count(*) < 100 THEN 'too_few_rows'
   WHEN count(*) FILTER (WHERE open IS NULL OR isnan(open) OR high IS NULL OR isnan(high) OR low IS NULL OR isnan(low) OR close IS NULL OR isnan(close) OR volume IS NULL OR isnan(volume)) > 0 THEN 'null_values'
   WHEN count(*) FILTER (WHERE close <= 0) > 0 THEN 'non_positive_close'
   WHEN count(*) FILTER (WHERE volume < 0) > 0 THEN 'negative_volume' END AS first_violation
FROM sbars GROUP BY ticker""",
    "training_set": f"{O.TRAINING_BASE} SELECT ticker, date, label, {O.r6(V2)} FROM ts",
    "time_split": f"{O.TRAINING_BASE} SELECT ticker, date, label, CASE WHEN date < {O.SPLIT} THEN 'train' ELSE 'test' END AS split FROM ts",
    "split_counts": f"{O.TRAINING_BASE} SELECT ticker, count(*) FILTER (WHERE date < {O.SPLIT}) AS train_rows, "
    f"count(*) FILTER (WHERE date >= {O.SPLIT}) AS test_rows, count(*) AS total_rows FROM ts GROUP BY ticker",
    "split_date": "SELECT DISTINCT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS run_date, "
    "strftime(CAST(ts AS DATE) - INTERVAL 90 DAY, '%Y-%m-%d') AS split_date FROM events",
    "training_stats": f"{O.TRAINING_BASE}, {O.STATS} SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM st",
    "fingerprint": f"{O.TRAINING_BASE} SELECT CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', ticker, CAST(epoch_us(date) AS VARCHAR), CAST(label AS VARCHAR), "
    + ", ".join(f"coalesce(CAST(CAST(round({c} * 1000000.0) AS BIGINT) AS VARCHAR), '')" for c in V2)
    + f")), 1, 15)) AS BIGINT)) AS VARCHAR) AS digest, count(*) AS rows FROM ts WHERE date < {O.SPLIT}",
    "drift_flags": f"{O.TRAINING_BASE}, {O.STATS}, {O.DRIFT} SELECT ticker, date, n_drifted > 0 AS drift_detected, "
    "drifted_features, n_drifted FROM dr",
    "drift_events_total": f"{O.TRAINING_BASE}, {O.STATS}, {O.DRIFT} SELECT ticker, count(*) AS drift_events_total FROM dr "
    "WHERE n_drifted > 0 GROUP BY ticker",
    "nearest_bar": f"{O.EVAL_BASE} SELECT ticker, prediction_date, model_version, CASE WHEN n_bars IS NOT NULL THEN bar_date END AS bar_date FROM res",
    "prediction_status": f"{O.EVAL_BASE} SELECT ticker, prediction_date, model_version, status, realized FROM res",
    "realized_direction": f"{O.EVAL_BASE} SELECT ticker, prediction_date, model_version, bar_date, round(c_t, 4) AS close_t, "
    "round(c_f, 4) AS close_forward, realized FROM res WHERE status = 'evaluated'",
    "prediction_results": f"{O.EVAL_BASE} SELECT ticker, prediction_date, direction AS predicted, realized, direction = realized AS correct, "
    "probability, round(c_t, 4) AS close_t, round(c_f, 4) AS close_forward FROM res WHERE status = 'evaluated'",
    "prediction_summary": f"{O.EVAL_BASE} SELECT count(*) FILTER (WHERE status = 'evaluated') AS evaluated, "
    "count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'skipped') AS skipped, "
    "coalesce(round(CAST(count(*) FILTER (WHERE status = 'evaluated' AND direction = realized) AS DOUBLE) / "
    "NULLIF(count(*) FILTER (WHERE status = 'evaluated'), 0), 4), 0.0) AS accuracy FROM res",
    "predictions_total": f"{O.LOG_BASE} SELECT ticker, direction, count(*) AS predictions_total FROM plog GROUP BY ticker, direction",
    "latency_histogram": "WITH l AS (SELECT value / 1000.0 AS x FROM events), a AS (SELECT "
    + ", ".join(f"count(*) FILTER (WHERE x <= {b}) AS b{i}" for i, b in enumerate(perf_op.LATENCY_BUCKETS))
    + ", count(x) AS binf, round(sum(x), 6) AS latency_sum, count(x) AS latency_count FROM l) "
    + " UNION ALL ".join(
        f"SELECT '{lab}' AS le, {col} AS bucket_count, latency_sum, latency_count FROM a"
        for lab, col in zip(
            [repr(b) for b in perf_op.LATENCY_BUCKETS] + ["+Inf"],
            [f"b{i}" for i in range(len(perf_op.LATENCY_BUCKETS))] + ["binf"],
        )
    ),
    "roc_auc": f"""WITH {O.BARS},{O.SCORED},
s AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM c""",
    "roc_auc_by_ticker": f"""WITH {O.BARS},{O.SCORED},
s AS (SELECT ticker, score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY ticker, score),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY ticker ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT ticker, round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM c GROUP BY ticker""",
    "classification_metrics": f"""WITH {O.BARS},{O.SCORED},
s AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY score),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s),
auc AS (SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS roc_auc FROM c),
k AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = prediction) AS ok,
        count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
        count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, avg(CAST(label AS DOUBLE)) AS label_balance FROM sc)
SELECT round(CAST(ok AS DOUBLE) / n, 6) AS accuracy,
  round(coalesce(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0), 6) AS precision_class1,
  round(coalesce(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0), 6) AS recall_class1,
  round(coalesce(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0.0), 6) AS f1_class1,
  round(label_balance, 6) AS label_balance, round(auc.roc_auc, 6) AS roc_auc FROM k, auc""",
    "run_versions": f"{O.RUNS_BASE} SELECT model, run_id, run_seq, version FROM rv",
    "promotion_history": f"{O.RUNS_BASE} SELECT model, run_id, run_seq, version, round(roc_auc, 6) AS roc_auc, promoted, "
    "champion_version, round(champion_auc, 6) AS champion_auc FROM fold",
    "alias_history": f"{O.RUNS_BASE} SELECT model, version, run_id, run_seq AS valid_from_seq, "
    "lead(run_seq) OVER (PARTITION BY model ORDER BY run_seq) AS valid_to_seq FROM fold WHERE promoted",
    "current_champion": f"{O.RUNS_BASE} SELECT model, arg_max(version, run_seq) AS champion_version, arg_max(run_id, run_seq) AS champion_run_id "
    "FROM fold WHERE promoted GROUP BY model",
    "champion_metrics": f"{O.RUNS_BASE}, ch AS (SELECT model, arg_max(version, run_seq) AS champion_version, arg_max(run_id, run_seq) AS champion_run_id "
    "FROM fold WHERE promoted GROUP BY model) SELECT ch.model, ch.champion_version, ch.champion_run_id, round(runs.roc_auc, 6) AS roc_auc "
    "FROM ch JOIN runs ON runs.run_id = ch.champion_run_id",
    "tail_n": f"WITH {O.BARS} SELECT ticker, date, close FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM bars) WHERE rn <= 100",
    "latest_features": f"""WITH RECURSIVE {O.BARS},{O.window_features()},{O.ema_window_recursive()},
last AS (SELECT ticker, max(date) AS d FROM bars GROUP BY ticker)
SELECT wf.ticker, strftime(wf.date, '%Y-%m-%d %H:%M:%S') AS prediction_date, {O.r6(V2[:-1], "wf.")},
       round(mw.macd_signal_window, 6) AS macd_signal
FROM wf JOIN last ON wf.ticker = last.ticker AND wf.date = last.d JOIN mw ON mw.ticker = wf.ticker AND mw.date = wf.date""",
    "backfill_range": f"WITH {O.BARS},{O.window_features()} SELECT ticker, date, {O.r6(V1)} FROM wf WHERE {O.not_null(V1)} "
    f"AND date >= TIMESTAMP '{BACKFILL_START}' AND date <= TIMESTAMP '{BACKFILL_END}'",
    "backfill_upsert": f"""WITH {O.BARS}, old_bars AS (SELECT * FROM bars WHERE date < TIMESTAMP '{UPSERT_OLD_END}'),
{O.window_features()},{O.window_features('old_bars', 'wo')},
ex AS (SELECT ticker, date, {_v(V1)} FROM wo WHERE {O.not_null(V1)}),
nw AS (SELECT ticker, date, {_v(V1)} FROM wf WHERE {O.not_null(V1)} AND date >= TIMESTAMP '{UPSERT_START}' AND date <= TIMESTAMP '{UPSERT_END}'),
m AS (SELECT * FROM ex WHERE NOT EXISTS (SELECT 1 FROM nw WHERE nw.ticker = ex.ticker AND nw.date = ex.date) UNION ALL SELECT * FROM nw)
SELECT ticker, date, {O.r6(V1)} FROM m""",
    "score_unknown_tickers": f"""{O.LOG_BASE}, lt AS (SELECT ticker, max(date) AS d FROM bars GROUP BY ticker)
SELECT r.ticker, CASE WHEN lt.d IS NULL THEN 'unknown_ticker' ELSE 'ok' END AS status, strftime(lt.d, '%Y-%m-%d %H:%M:%S') AS prediction_date
FROM (SELECT DISTINCT ticker FROM plog) r LEFT JOIN lt ON lt.ticker = r.ticker""",
    "sliding_windows": f"""WITH {O.BARS}
SELECT ticker, first(date) OVER w AS window_start, date AS window_end, count(*) OVER w AS n_rows, first(close) OVER w AS close_first,
       close AS close_last, round(sum(close) OVER w, 6) AS close_sum
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {WINDOW_SIZE - 1} PRECEDING AND CURRENT ROW)
QUALIFY count(*) OVER w = {WINDOW_SIZE}""",
    "normalize_bars": f"WITH {O.BARS} SELECT ticker, date, open, high, low, close, volume FROM bars "
    f"WHERE date >= TIMESTAMP '{NORMALIZE_START}' AND date < TIMESTAMP '{NORMALIZE_END}'",
    "load_ticker": f"WITH {O.BARS} SELECT ticker, date, open, high, low, close, volume FROM bars WHERE ticker = '{LOAD_ONE}'",
    "load_all": f"WITH {O.BARS} SELECT ticker, date, open, high, low, close, volume FROM bars WHERE ticker IN ({', '.join(repr(t) for t in LOAD_MANY)})",
    "prediction_log_roundtrip": f"{O.LOG_BASE} SELECT ticker, prediction_date, direction, probability, model_version FROM plog",
    "stream_rows": f"WITH {O.BARS} SELECT ticker, date, open, high, low, close, volume FROM bars",
    "stream_windows": f"""WITH {O.BARS}
SELECT ticker, first(date) OVER w AS window_start, date AS window_end, count(*) OVER w AS n_rows, first(close) OVER w AS close_first,
       close AS close_last, round(sum(close) OVER w, 6) AS close_sum, CAST(0 AS BIGINT) AS late_rows
FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {WINDOW_SIZE - 1} PRECEDING AND CURRENT ROW)
QUALIFY count(*) OVER w = {WINDOW_SIZE}""",
    "stream_features": f"WITH RECURSIVE {O.BARS},{O.window_features()},{O.ema_recursive()},{O.FEATURES_V2_TABLE} "
    f"SELECT ticker, date, {O.r6(V2)} FROM fv2",
}

ORACLES |= {
    "ema_scan": ORACLES["ema"],
    "macd_signal_scan": ORACLES["macd_signal"],
    "training_frame": ORACLES["training_set"],
    "training_frame_chunked": ORACLES["training_set"],
    "training_stats_roundtrip": ORACLES["training_stats"],
    "forward_labels_chunked": ORACLES["forward_labels"],
    "feature_store_roundtrip": ORACLES["features_v1"],
    "backfill_store": ORACLES["backfill_upsert"],
    "gbt_metrics": f"{O.TRAINING_BASE} SELECT round(avg(CAST(label AS DOUBLE)), 6) AS label_balance, true AS in_range FROM ts WHERE date >= {O.SPLIT}",
    "batch_predictions": f"{O.TRAINING_BASE} SELECT ticker, date, true AS in_range FROM ts WHERE date >= {O.SPLIT}",
    "baseline_run": f"WITH {O.BARS},{O.labels()} SELECT CAST(1 AS BIGINT) AS run_seq, round(avg(CAST(label AS DOUBLE)), 6) AS label_balance, "
    f"'{SPLIT_DATE}' AS test_split_date, 'open,high,low,close,volume' AS feature_columns, '200' AS n_estimators, true AS in_range "
    f"FROM lb WHERE label IS NOT NULL AND date >= {O.SPLIT}",
    "engineered_run": f"WITH RECURSIVE fp AS ({ORACLES['fingerprint']}), "
    f"n AS ({O.TRAINING_BASE} SELECT count(*) FILTER (WHERE date < {O.SPLIT}) AS a, count(*) FILTER (WHERE date >= {O.SPLIT}) AS b, "
    f"avg(CAST(label AS DOUBLE)) FILTER (WHERE date >= {O.SPLIT}) AS y FROM ts) "
    f"SELECT CAST(1 AS BIGINT) AS run_seq, round(n.y, 6) AS label_balance, '{SPLIT_DATE}' AS test_split_date, '{','.join(V2)}' AS feature_columns, "
    "fp.digest || ':' || CAST(fp.rows AS VARCHAR) AS train_data_fingerprint, CAST(n.a AS VARCHAR) AS train_rows, CAST(n.b AS VARCHAR) AS test_rows, "
    "'200' AS n_estimators, true AS in_range FROM n, fp",
    "champion_scoring": f"""{O.LOG_BASE}, lt AS (SELECT ticker, max(date) AS d, count(*) AS n FROM bars GROUP BY ticker)
SELECT r.ticker, CASE WHEN lt.d IS NULL THEN 'unknown_ticker' WHEN lt.n < 100 THEN 'short_history' ELSE 'ok' END AS status,
  CASE WHEN lt.n >= 100 THEN strftime(lt.d, '%Y-%m-%d %H:%M:%S') END AS prediction_date, CASE WHEN lt.n >= 100 THEN true END AS in_range
FROM (SELECT DISTINCT ticker FROM plog) r LEFT JOIN lt ON lt.ticker = r.ticker""",
}

_ROW_TEXT = (
    "concat_ws('|', ticker, CAST(epoch_us(date) AS VARCHAR), CAST(label AS VARCHAR), "
    + ", ".join(f"coalesce(CAST(CAST(round({c} * 1000000.0) AS BIGINT) AS VARCHAR), '')" for c in V2)
    + ")"
)
_ALL_DRIFT = O.DRIFT.replace("FROM ts WHERE date >= " + O.SPLIT, "FROM fv2")


def _over_last(window: int, value: str) -> str:
    """A user feature at the last bar, null of fewer than ``window`` bars."""
    return f"CASE WHEN count(*) FILTER (WHERE rn <= {window}) = {window} THEN {value.format(w=f'FILTER (WHERE rn <= {window})')} END"


ORACLES |= {
    "training_set_bucketed": ORACLES["training_set"],
    "stream_windows_chunked": ORACLES["sliding_windows"],
    "predictions_total_stream": ORACLES["predictions_total"],
    "drift_events_total_stream": ORACLES["drift_events_total"],
    "fingerprint_ordered": f"{O.TRAINING_BASE} SELECT CAST(sum(CAST(('0x' || substr(md5(CAST(pos AS VARCHAR) || '|' || row_text), 1, 15)) AS BIGINT)) AS VARCHAR) AS digest, "
    f"count(*) AS rows FROM (SELECT row_number() OVER (ORDER BY ticker, date) - 1 AS pos, {_ROW_TEXT} AS row_text FROM ts WHERE date < {O.SPLIT})",
    "stream_scores": f"{O.TRAINING_BASE}, {O.STATS}, {_ALL_DRIFT} SELECT b.ticker, b.date, CASE WHEN dr.ticker IS NULL THEN 'short_history' ELSE 'ok' END AS status, "
    "dr.n_drifted > 0 AS drift_detected, dr.drifted_features, CASE WHEN dr.ticker IS NOT NULL THEN '1' END AS model_version, "
    "CAST(dr.ticker IS NOT NULL AS BIGINT) AS logged, CASE WHEN dr.ticker IS NOT NULL THEN true END AS in_range "
    "FROM bars b LEFT JOIN dr ON dr.ticker = b.ticker AND dr.date = b.date",
    "stream_champions": f"WITH RECURSIVE {O.BARS},{O.window_features()},{O.ema_recursive()},{O.FEATURES_V2_TABLE},{O.RUNS}, "
    f"mine AS (SELECT * FROM fold WHERE model = '{REGISTRY_MODEL}' AND promoted) "
    f"SELECT ticker, date, CAST(CASE WHEN date < TIMESTAMP '{STREAM_SPLIT}' "
    f"THEN (SELECT arg_max(version, run_seq) FROM mine WHERE run_seq <= DATE '{REGISTRY_CUT}' - DATE '1970-01-01') "
    "ELSE (SELECT arg_max(version, run_seq) FROM mine) END AS VARCHAR) AS model_version FROM fv2",
    "latest_features_grouped": f"""WITH {O.BARS}, u AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS rn FROM bars)
SELECT ticker, strftime(max(date), '%Y-%m-%d %H:%M:%S') AS prediction_date,
  round((max(close) FILTER (WHERE rn = 1) - max(close) FILTER (WHERE rn = 2)) / NULLIF(max(close) FILTER (WHERE rn = 2), 0), 6) AS return_1d,
  round({_over_last(15, "median(close) {w}")}, 6) AS median_15,
  round({_over_last(30, "(max(close) FILTER (WHERE rn = 1) - min(low) {w}) / (max(high) {w} - min(low) {w})")}, 6) AS range_position_30,
  round({_over_last(10, "sum(high - low) {w}")}, 6) AS spread_sum_10
FROM u GROUP BY ticker""",
    "online_parity": f"WITH {O.BARS} SELECT DISTINCT ticker, feature, true AS same FROM bars, "
    f"(SELECT unnest([{', '.join(repr(f.name) for f in USER_SET.features)}]) AS feature)",
    "request_answers": f"""{O.LOG_BASE}, lt AS (SELECT ticker, max(date) AS d FROM bars GROUP BY ticker)
SELECT r.ticker, r.prediction_date, r.model_version, CASE WHEN lt.d IS NULL THEN 'unknown_ticker' ELSE 'ok' END AS status,
  strftime(lt.d, '%Y-%m-%d %H:%M:%S') AS latest_bar FROM plog r LEFT JOIN lt ON lt.ticker = r.ticker""",
    "run_log": f"WITH RECURSIVE fp AS ({ORACLES['fingerprint']}), "
    f"n AS ({O.TRAINING_BASE} SELECT count(*) FILTER (WHERE date < {O.SPLIT}) AS a, count(*) FILTER (WHERE date >= {O.SPLIT}) AS b FROM ts), "
    f"o AS (WITH {O.BARS},{O.labels()} SELECT count(*) FILTER (WHERE date < {O.SPLIT}) AS a, count(*) FILTER (WHERE date >= {O.SPLIT}) AS b FROM lb WHERE label IS NOT NULL), "
    "t AS (SELECT string_agg(event_type, ',' ORDER BY event_type) AS tickers FROM (SELECT DISTINCT event_type FROM events)), "
    f"p AS (SELECT '{SPLIT_DATE}' AS test_split_date, '5' AS n_estimators, '4' AS max_depth, '0.05' AS learning_rate, '0.8' AS subsample, '0.8' AS colsample_bytree, '42' AS random_state, false AS dry_run) "
    "SELECT CAST(1 AS BIGINT) AS run_seq, 'baseline_classifier' AS model, tickers, 'open,high,low,close,volume' AS feature_columns, CAST(a AS VARCHAR) AS train_rows, CAST(b AS VARCHAR) AS test_rows, "
    "p.*, NULL AS feature_set, NULL AS feature_set_version, NULL AS train_data_fingerprint FROM o, t, p UNION ALL "
    f"SELECT CAST(2 AS BIGINT), 'direction_classifier', tickers, '{','.join(V2)}', CAST(a AS VARCHAR), CAST(b AS VARCHAR), p.*, 'engineered', '2', "
    "fp.digest || ':' || CAST(fp.rows AS VARCHAR) FROM n, t, p, fp",
}

_p = FIRST_TREES
_BOOSTED = f"{O.TRAINING_BASE}, " + O.boosted_trees(
    V2, [boosting.drawn_columns(V2, t, _p) for t in range(_p.trees)], _p.depth, _p.bins, _p.rate, _p.rows, _p.seed, _p.ridge, _p.min_hessian
)
ORACLES |= {
    "boosted_nodes": f"{_BOOSTED} SELECT tree, node, feature, cut, {O.r6(['gain', 'hessian', 'weight'])} FROM nd",
    "boosted_rounds": f"{_BOOSTED} SELECT tree, {O.r6(['log_loss'])} FROM ls",
}

ORACLES |= {
    "ordered_bars": f"WITH {O.BARS} SELECT row_number() OVER (ORDER BY ticker, date) - 1 AS row_no, ticker, date, close FROM bars "
    f"WHERE ticker IN ({', '.join(repr(t) for t in LOAD_MANY)})",
    "merged_order": f"WITH {O.BARS} SELECT row_number() OVER (ORDER BY ticker, date) - 1 AS row_no, ticker, date, "
    f"CASE WHEN date < TIMESTAMP '{UPSERT_START}' THEN close + 1000 ELSE close END AS close FROM bars",
    "log_timestamps": f"{O.LOG_BASE} SELECT ticker, count(*) AS rows, true AS in_interval FROM plog GROUP BY ticker",
}
