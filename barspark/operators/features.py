"""Offline feature table (W1-W7, W11): every feature of a set for every bar, one plan for all tickers."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barspark.functions.features import HELPERS, FeatureSet, with_helpers
from barspark.operators import ema as ema_op
from barspark.operators.sequence import CORE, chunk_window, core_only, frame, time_order
from barspark.schemas import DATE, TICKER


def sequenced_chunks(
    bars: DataFrame,
    back: int,
    fwd: int = 0,
    keys: list[str] | None = None,
    time: str = DATE,
    chunk_rows: int | None = None,
) -> DataFrame:
    keys = keys or [TICKER]
    return frame(bars, keys, time_order(bars, time), back=back, fwd=fwd, chunk_rows=chunk_rows)


def compute_features(
    bars: DataFrame,
    fs: FeatureSet,
    keys: list[str] | None = None,
    time: str = DATE,
    dropna: bool = True,
    chunk_rows: int | None = None,
    keep: list[str] | None = None,
    extra: dict | None = None,
    fwd: int = 0,
) -> DataFrame:
    """``keys, time, *keep, *features, *extra`` for every bar; rows with any null feature dropped.

    ``extra`` maps names to more window builders computed in the same pass (``fwd`` rows of
    look-ahead halo), e.g. the forward label, so a training set needs no second pass or join.

    One range exchange (sequence), one hash exchange on (ticker, chunk); the window features
    share a single sort, and the EMA part (if any) reuses the same partitioning.
    """
    keys = keys or [TICKER]
    keep = keep or []
    extra = extra or {}
    rows = sequenced_chunks(bars, back=fs.lookback, fwd=fwd, keys=keys, time=time, chunk_rows=chunk_rows)
    w = chunk_window(keys, time_order(bars, time))
    rows = with_helpers(rows, w)
    rows = rows.withColumns({f.name: f.build(w) for f in fs.window_features})
    rows = rows.withColumns({name: build(w) for name, build in extra.items()}).drop(*HELPERS)
    if fs.pandas_features:
        rows = ema_op.with_pandas_features(rows, keys, fs.pandas_features, time_order(bars, time))
    out = core_only(rows).select(*keys, time, *keep, *fs.feature_names, *extra.keys())
    if dropna:
        out = out.dropna(how="any", subset=fs.feature_names)
    return out


def ema_table(
    bars: DataFrame,
    keys: list[str] | None = None,
    time: str = DATE,
    chunk_rows: int | None = None,
    ema_halo: int | None = None,
) -> DataFrame:
    """Full-history EMA12, EMA26, MACD line and signal for every bar."""
    keys = keys or [TICKER]
    halo = ema_halo if ema_halo is not None else ema_op.ema_halo()
    rows = sequenced_chunks(bars, back=halo, keys=keys, time=time, chunk_rows=chunk_rows)
    order = time_order(bars, time)
    rows = ema_op.with_macd(rows, keys, ["ema_12", "ema_26", "macd", "macd_signal"], order, keep=[time, CORE])
    return core_only(rows).select(*keys, time, "close", "ema_12", "ema_26", "macd", "macd_signal")


def window_columns(
    bars: DataFrame,
    columns: dict,
    back: int,
    fwd: int = 0,
    keys: list[str] | None = None,
    time: str = DATE,
    chunk_rows: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Generic bounded-window projection: ``columns`` maps name -> builder(window) -> Column."""
    keys = keys or [TICKER]
    rows = sequenced_chunks(bars, back=back, fwd=fwd, keys=keys, time=time, chunk_rows=chunk_rows)
    w = chunk_window(keys, time_order(bars, time))
    rows = with_helpers(rows, w)
    rows = rows.withColumns({name: build(w) for name, build in columns.items()})
    keep = keep if keep is not None else [c for c in bars.columns if c not in keys and c != time]
    return core_only(rows).select(*keys, time, *keep, *columns.keys())
