"""Per-ticker stream state in Spark's own state store.

Each ticker holds its last ``keep`` bars and the values that recursive features need (three doubles for the MACD
signal), however long its history is.  :func:`with_tails` puts out, for every ticker of a micro-batch, the bars held from
before (``_new`` false) and the new bars (``_new`` true), so that what follows is a plain batch computation over
bounded look-backs.  Rows that come late, or twice, are counted (one row with ``_new`` null).

State is versioned by Spark's checkpoint: a retried micro-batch starts from the state before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barspark.functions.features import Feature
from barspark.schemas import BARS, DATE, PRICE_COLUMNS, TICKER

NEW, LATE = "_new", "_late"
STATE = "dates array<timestamp_ntz>, " + ", ".join(f"{c} array<double>" for c in PRICE_COLUMNS) + ", recursions array<array<double>>, late bigint"


def _bars(dates=(), values=()) -> pd.DataFrame:
    cols = {DATE: pd.Series(pd.to_datetime(list(dates)), dtype="datetime64[us]")}
    return pd.DataFrame(cols | {c: pd.Series(v, dtype="float64") for c, v in zip(PRICE_COLUMNS, values or [[]] * len(PRICE_COLUMNS))})


def _in_order(bars: pd.DataFrame) -> pd.DataFrame:
    """By date; of bars that repeat a date the first by their values stays."""
    return bars.sort_values([DATE, *PRICE_COLUMNS], kind="stable", na_position="last", ignore_index=True).drop_duplicates(DATE, ignore_index=True)


def with_tails(bars: DataFrame, keep: int, recursive: list[Feature] | None = None) -> DataFrame:
    """Streaming ``ticker, date, open, high, low, close, volume, _new, _late, <recursive features>``.

    A new bar is one dated after the ticker's newest held one; repeats inside a micro-batch leave one bar by a fixed order of the values.
    With recursive features a ticker's new bars are put in order and run through the recursions (a task holds one
    ticker's bars of one micro-batch, which the source bounds); without any, Arrow batches pass through one by
    one and a task holds ``keep`` bars, so a repeat inside a micro-batch stays for the reader to drop.
    """
    feats = list(recursive or [])
    names = [f.name for f in feats]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BARS.fields)
    schema += f", {NEW} boolean, {LATE} bigint" + "".join(f", {n} double" for n in names)
    columns = [*BARS.names, NEW, LATE, *names]

    def rows(ticker, own: pd.DataFrame, new: bool) -> pd.DataFrame:
        return own.assign(**{TICKER: ticker, NEW: new, LATE: 0}).reindex(columns=columns)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, carried, late = _bars(), [None] * len(feats), 0
        if state.exists:
            dates, *values, recursions, late = state.get
            held, carried = _bars(dates, values), [list(r) if r is not None else None for r in recursions]
        newest = held[DATE].iloc[-1] if len(held) else None
        tail, dropped, shown = held, 0, False

        def fresh(batch: pd.DataFrame) -> pd.DataFrame:
            own = batch[[DATE, *PRICE_COLUMNS]].astype({DATE: "datetime64[us]"} | dict.fromkeys(PRICE_COLUMNS, "float64"))
            return own if newest is None else own[own[DATE] > newest]

        if feats:
            own = pd.concat(list(batches), ignore_index=True)
            new = _in_order(fresh(own))
            dropped = len(own) - len(new)
            for i, f in enumerate(feats):
                new[f.name], carried[i] = f.recursion(new["close"].to_numpy(), carried[i])
            if len(new):
                yield rows(key[0], held, False)
                yield rows(key[0], new, True)
            tail = pd.concat([held, new[held.columns]], ignore_index=True)
        else:
            for batch in batches:
                new = fresh(batch)
                dropped += len(batch) - len(new)
                if len(new):
                    if not shown:
                        yield rows(key[0], held, False)
                    shown = True
                    yield rows(key[0], new, True)
                    tail = pd.concat([tail, _in_order(new).tail(keep)], ignore_index=True)
                    tail = _in_order(tail).tail(keep)
        if dropped:
            yield pd.DataFrame([{TICKER: key[0], LATE: dropped}]).reindex(columns=columns).astype({DATE: "datetime64[us]"})
        tail = tail.tail(keep)
        values = [[None if x != x else x for x in tail[c].tolist()] for c in PRICE_COLUMNS]
        state.update(([d.to_pydatetime() for d in tail[DATE]], *values, carried, int(late + dropped)))

    return bars.groupBy(TICKER).applyInPandasWithState(step, schema, STATE, "append", GroupStateTimeout.NoTimeout)
