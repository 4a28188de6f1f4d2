"""Count-based sliding windows on a stream (ST2): the last N rows per ticker, emitted when full.

State per ticker is a bounded buffer of the last N-1 rows (``applyInPandasWithState``).  Rows
for a ticker within a micro-batch are put in date order; a row not later than the newest
buffered date is late: it is dropped from the window sequence and counted, and a duplicate
(ticker, date) keeps the first arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barspark.schemas import DATE, TICKER

WINDOW_OUT = (
    "ticker string, window_start timestamp_ntz, window_end timestamp_ntz, n_rows long, "
    "close_first double, close_last double, close_sum double, late_rows long"
)
ROWS_FIELD = "rows array<struct<date:timestamp_ntz,open:double,high:double,low:double,close:double,volume:double>>"
STATE = (
    "dates array<timestamp_ntz>, opens array<double>, highs array<double>, lows array<double>, "
    "closes array<double>, volumes array<double>, late long"
)
VALUES = ["open", "high", "low", "close", "volume"]


def stream_windows(bars: DataFrame, size: int, dedupe_within: str | None = None, emit_rows: bool = False) -> DataFrame:
    """Streaming DataFrame of one row per full window of ``size`` consecutive bars per ticker.

    Each window row has its bounds and close summaries; ``emit_rows`` adds ``rows``, the window's
    ``size`` bars in time order (what an online feature function consumes), bounded by ``size``.
    ``dedupe_within`` (e.g. ``"1 day"``) drops repeated (ticker, date) rows from a source that can
    replay, with a watermark on ``date`` bounding the de-duplication state.  Micro-batch size
    (``maxFilesPerTrigger``) bounds the rows one key brings into a single state update.
    """
    if dedupe_within:
        # watermarks need a zoned timestamp; the bar date is a wall clock, so derive one
        bars = (
            bars.withColumn("_event_time", F.col(DATE).cast("timestamp"))
            .withWatermark("_event_time", dedupe_within)
            .dropDuplicatesWithinWatermark([TICKER, DATE])
            .drop("_event_time")
        )
    keep = max(size - 1, 0)
    cols = ["ticker", "window_start", "window_end", "n_rows", "close_first", "close_last", "close_sum", "late_rows"]
    out_schema = WINDOW_OUT + (", " + ROWS_FIELD if emit_rows else "")
    if emit_rows:
        cols = cols + ["rows"]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, late = pd.DataFrame({DATE: pd.Series(dtype="datetime64[us]"), **{v: pd.Series(dtype="float64") for v in VALUES}}), 0
        if state.exists:
            dates, *vals, late = state.get
            held = pd.DataFrame({DATE: pd.to_datetime(pd.Series(list(dates))).astype("datetime64[us]"), **{v: pd.Series(list(x), dtype="float64") for v, x in zip(VALUES, vals)}})
        new = pd.concat(list(batches), ignore_index=True)[[DATE, *VALUES]].sort_values(DATE, kind="stable", ignore_index=True)
        new[DATE] = new[DATE].astype("datetime64[us]")
        is_late = new[DATE].duplicated() | (new[DATE] <= held[DATE].iloc[-1] if len(held) else False)
        late_upto = (late + is_late.cumsum())[~is_late].to_numpy()
        rows = pd.concat([held, new[~is_late]], ignore_index=True) if len(held) else new[~is_late].reset_index(drop=True)
        # windows that end at a new row and are full
        ends = np.arange(max(len(held), size - 1), len(rows))
        times, closes = rows[DATE].to_numpy(), rows["close"].to_numpy(dtype="float64")
        out = pd.DataFrame({"ticker": [key[0]] * len(ends)})
        out["window_start"], out["window_end"], out["n_rows"] = times[ends - size + 1], times[ends], size
        out["close_first"], out["close_last"] = closes[ends - size + 1], closes[ends]
        views = np.lib.stride_tricks.sliding_window_view(closes, size) if len(closes) >= size else np.zeros((0, size))
        out["close_sum"] = views[ends - size + 1].sum(axis=1)
        out["late_rows"] = late_upto[ends - len(held)]
        if emit_rows:
            each = rows.astype({DATE: object}).to_dict("records")
            out["rows"] = [each[e - size + 1 : e + 1] for e in ends]
        last = rows.tail(keep) if keep else rows.head(0)
        values = [[None if x != x else x for x in last[v].tolist()] for v in VALUES]
        state.update(([d.to_pydatetime() for d in last[DATE]], *values, int(late + is_late.sum())))
        yield out[cols]

    return bars.groupBy(TICKER).applyInPandasWithState(step, out_schema, STATE, "append", GroupStateTimeout.NoTimeout)


def stream_windows_chunked(bars: DataFrame, size: int, sink_path: str, checkpoint: str, chunk_rows: int | None = None) -> None:
    """ST2 for tickers of any heat: drains what is there into one row per full window of ``size`` bars.

    The state holds ``size - 1`` bars a ticker and lets new bars pass Arrow batch by Arrow batch; the windows of a
    micro-batch are cut out of chunks of at most ``chunk_rows`` bars, each behind the ``size - 1`` bars before it, so
    no task holds more than a chunk of a ticker.  Columns as :func:`stream_windows`, without the count of late rows
    (late and repeated rows are left out).  A retried epoch writes its folder again.
    """
    from barspark.operators.features import window_columns
    from barspark.schemas import PRICE_COLUMNS
    from barspark.sources import fsutil
    from barspark.streaming.state import NEW, with_tails

    def frame(w):
        return w.rowsBetween(-(size - 1), 0)

    columns = {
        "window_start": lambda w: F.first(DATE).over(frame(w)),
        "n_rows": lambda w: F.count(F.lit(1)).over(frame(w)),
        "close_first": lambda w: F.first("close").over(frame(w)),
        "close_last": lambda w: F.col("close"),
        "close_sum": lambda w: F.sum("close").over(frame(w)),
    }

    def each(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()  # the stateful step runs once for the count of hot tickers and the windows
        try:
            pick = Window.partitionBy(TICKER, DATE).orderBy(*[F.col(c).asc_nulls_last() for c in PRICE_COLUMNS])
            rows = batch.where(F.col(NEW).isNotNull()).withColumn("_pick", F.row_number().over(pick)).where("_pick = 1")
            rows = rows.select(TICKER, DATE, *PRICE_COLUMNS, NEW)
            out = window_columns(rows, columns, back=size - 1, chunk_rows=chunk_rows, keep=[NEW])
            out = out.where((F.col("n_rows") == size) & F.col(NEW)).drop(NEW).withColumnRenamed(DATE, "window_end")
            out.write.mode("overwrite").parquet(fsutil.join(sink_path, f"epoch={epoch}"))
        finally:
            batch.unpersist()

    started = with_tails(bars, size - 1).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    started.trigger(availableNow=True).start().awaitTermination()
