"""Bar validation (P10-P15): one grouped pass gives every count; the first failing rule is named.

Rules, in the order they are reported:
required columns -> at least 100 rows -> no null/NaN in the value columns -> close > 0 ->
volume >= 0 -> dates non-decreasing in arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.operators.sequence import chunk_window, core_only, frame
from barspark.schemas import DATE, TICKER

# Fixed values that must equal the reference's.
REQUIRED_COLUMNS = ["open", "high", "low", "close", "volume", "ticker"]
MIN_ROWS_PER_TICKER = 100

VALUE_COLUMNS = ["open", "high", "low", "close", "volume"]


def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    have = set(df.columns)
    return [c for c in (required or REQUIRED_COLUMNS) if c not in have]


def _is_missing(c: str):
    return F.col(c).isNull() | F.isnan(F.col(c))


def unsorted_counts(bars: DataFrame, arrival: str, keys: list[str] | None = None, time: str = DATE) -> DataFrame:
    """Per key: rows whose date is earlier than the previous row's in arrival order."""
    keys = keys or [TICKER]
    rows = frame(bars.select(*keys, time, arrival), keys, [arrival], back=1)
    prev = F.lag(time, 1).over(chunk_window(keys, [arrival]))
    flagged = core_only(rows.withColumn("_back", (prev > F.col(time)).cast("int")))
    return flagged.groupBy(*keys).agg(F.coalesce(F.sum("_back"), F.lit(0)).cast("long").alias("unsorted_dates"))


def validation_report(
    bars: DataFrame,
    arrival: str | None = None,
    keys: list[str] | None = None,
    time: str = DATE,
    min_rows: int = MIN_ROWS_PER_TICKER,
) -> DataFrame:
    """One row per ticker with every violation count and ``first_violation`` (null when valid).

    ``repeated_dates`` counts the bars beyond the first of each date.  It is reported, not a violation: bars may
    repeat a date, and the operators then order them by arrival and values.
    """
    keys = keys or [TICKER]
    missing = missing_columns(bars)
    if missing:
        raise ValueError(f"bars lack the columns {sorted(missing)}")
    counts = bars.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(_is_missing(c)).alias(f"null_{c}") for c in VALUE_COLUMNS],
        F.count_if(F.col("close") <= 0).alias("non_positive_close"),
        F.count_if(F.col("volume") < 0).alias("negative_volume"),
        (F.count(time) - F.count_distinct(time)).alias("repeated_dates"),
    )
    if arrival is not None:
        counts = counts.join(unsorted_counts(bars, arrival, keys, time), keys, "left").withColumn(
            "unsorted_dates", F.coalesce(F.col("unsorted_dates"), F.lit(0).cast("long"))
        )
    else:
        counts = counts.withColumn("unsorted_dates", F.lit(0).cast("long"))
    nulls = sum((F.col(f"null_{c}") for c in VALUE_COLUMNS), F.lit(0))
    first = (
        F.when(F.col("n_rows") < min_rows, "too_few_rows")
        .when(nulls > 0, "null_values")
        .when(F.col("non_positive_close") > 0, "non_positive_close")
        .when(F.col("negative_volume") > 0, "negative_volume")
        .when(F.col("unsorted_dates") > 0, "unsorted_dates")
    )
    return counts.withColumn("first_violation", first)


def validate(bars: DataFrame, arrival: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Strict mode: raise ``ValueError`` naming the ticker and the first failing rule.

    Bars with an ``arrival`` column are checked for their order of arrival as well (P15).
    """
    arrival = arrival or ("arrival" if "arrival" in bars.columns else None)
    keys = keys or [TICKER]
    report = validation_report(bars, arrival, keys)
    bad = report.where(F.col("first_violation").isNotNull()).orderBy(*keys).limit(1).collect()
    if bad:
        row = bad[0]
        who = ",".join(str(row[k]) for k in keys)
        rule = row["first_violation"]
        said = {
            "too_few_rows": f"{row['n_rows']} bars, {MIN_ROWS_PER_TICKER} needed",
            "null_values": "missing values: " + ", ".join(f"{c} {row[f'null_{c}']}" for c in VALUE_COLUMNS if row[f"null_{c}"]),
            "non_positive_close": f"{row['non_positive_close']} bars close at zero or below",
            "negative_volume": f"{row['negative_volume']} bars have a volume below zero",
            "unsorted_dates": f"{row['unsorted_dates']} bars arrived before an earlier date",
        }
        raise ValueError(f"{who}: {rule} ({said[rule]})")
    return bars
