"""Forward labels and time splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.operators.sequence import chunk_window, core_only, frame, time_order
from barspark.schemas import DATE, TICKER

# Fixed values that must equal the reference's.
FORWARD_DAYS = 5
EVALUATION_WINDOW_DAYS = 90
BASELINE_SPLIT_DATE = "2023-01-01"


def forward_label(close: Column, future: Column) -> Column:
    """1 if the future close is higher, 0 if equal or lower, null when there is no future row.

    A NaN future close counts as missing (pandas), and ``x > NaN`` is false in both engines.
    """
    return F.when(future.isNotNull() & ~F.isnan(future), (future > close).cast("int"))


def add_labels(
    bars: DataFrame,
    forward: int = FORWARD_DAYS,
    keys: list[str] | None = None,
    time: str = DATE,
    chunk_rows: int | None = None,
    with_horizon: bool = False,
) -> DataFrame:
    """Bars + ``label``: ``lead(close, n)`` inside each ticker (never across tickers).

    ``with_horizon`` adds ``label_date``, the date of the bar the label looks at (for purging).
    """
    keys = keys or [TICKER]
    order = time_order(bars, time)
    rows = frame(bars, keys, order, fwd=forward, chunk_rows=chunk_rows)
    w = chunk_window(keys, order)
    labelled = rows.withColumn("label", forward_label(F.col("close"), F.lead("close", forward).over(w)))
    if with_horizon:
        labelled = labelled.withColumn("label_date", F.lead(time, forward).over(w))
    return core_only(labelled).drop("_seq")


def drop_unlabeled(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["label"])


def time_split_column(split_date: str, time: str = DATE) -> Column:
    """'train' strictly before the split date (midnight), 'test' on or after it."""
    cut = F.to_timestamp_ntz(F.lit(split_date))
    return F.when(F.col(time) < cut, F.lit("train")).otherwise(F.lit("test"))


def time_split(
    df: DataFrame,
    split_date: str,
    time: str = DATE,
    end_date: str | None = None,
    purge: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(train, test): train before the split date, test from it.

    Defaults equal the reference.  ``end_date`` bounds the test period (exclusive); ``purge``
    drops train rows whose label looks at a bar on or after the split (needs ``label_date``
    from ``add_labels(with_horizon=True)``), so no training label leaks into the test period.
    """
    cut = F.to_timestamp_ntz(F.lit(split_date))
    train, test = df.where(F.col(time) < cut), df.where(F.col(time) >= cut)
    if end_date is not None:
        test = test.where(F.col(time) < F.to_timestamp_ntz(F.lit(end_date)))
    if purge:
        train = train.where(F.col("label_date").isNull() | (F.col("label_date") < cut))
    return train, test


def split_date_column(run_date: Column, eval_window: int = EVALUATION_WINDOW_DAYS) -> Column:
    """ISO date ``run_date - eval_window days``."""
    return F.date_format(F.date_sub(F.to_date(run_date), eval_window), "yyyy-MM-dd")


def compute_split_date(spark, run_date: str, eval_window: int = EVALUATION_WINDOW_DAYS) -> str:
    import datetime as _dt

    return (_dt.date.fromisoformat(run_date) - _dt.timedelta(days=eval_window)).isoformat()
