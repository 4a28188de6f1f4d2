"""Bar tables: normalise raw vendor-style frames, write/read the partitioned bar table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.functions.features import BASELINE_COLUMNS
from barspark.functions.columns import nan_to_null
from barspark.schemas import BARS, DATE, TICKER


def normalize_bars(
    raw: DataFrame,
    start: str,
    end: str,
    time_col: str = "Date",
    ticker_col: str = "Symbol",
    exchange_tz: str = "America/New_York",
    check_empty: bool = True,
) -> DataFrame:
    """Keep OHLCV, lower-case names, wall clock of the exchange, ``[start, end)``.

    ``time_col`` may be a zoned timestamp (converted to the exchange's wall clock) or already a
    wall-clock ``timestamp_ntz``.  An empty result for any requested ticker is an error.
    """
    lower = {c.lower(): c for c in raw.columns}
    missing = [c for c in BASELINE_COLUMNS if c not in lower]
    if missing:
        raise ValueError(f"the raw frame lacks the columns {missing}")
    ts = F.col(time_col)
    if raw.schema[time_col].dataType.typeName() == "timestamp":
        session_tz = raw.sparkSession.conf.get("spark.sql.session.timeZone")
        ts = F.convert_timezone(F.lit(session_tz), F.lit(exchange_tz), ts.cast("timestamp_ntz"))
    out = raw.select(
        F.col(ticker_col).cast("string").alias(TICKER),
        ts.cast("timestamp_ntz").alias(DATE),
        *[F.col(lower[c]).cast("double").alias(c) for c in BASELINE_COLUMNS],
    ).where((F.col(DATE) >= F.to_timestamp_ntz(F.lit(start))) & (F.col(DATE) < F.to_timestamp_ntz(F.lit(end))))
    if check_empty:
        requested = raw.select(F.col(ticker_col).cast("string").alias(TICKER)).distinct()
        empty = requested.join(out.select(TICKER).distinct(), TICKER, "left_anti").limit(1).collect()
        if empty:
            raise ValueError(f"ticker {empty[0][TICKER]!r} has no bars in {start} .. {end}")
    return out


def write_bars(bars: DataFrame, path: str, mode: str = "overwrite", layout: str = "ticker") -> str:
    """Write the bar table; dynamic partition overwrite replaces only the partitions written.

    * ``layout="ticker"``: one directory per ticker (few instruments, like the reference's file
      per ticker); a single-ticker read prunes directories.
    * ``layout="month"``: one directory per month, rows range-partitioned and sorted by
      (ticker, date) inside it, so files hold contiguous ticker ranges.  For wide panels (many
      thousands of tickers) this avoids a directory per ticker; a single-ticker read skips row
      groups by their ticker min/max statistics.
    """
    cols = [f.name for f in BARS.fields]
    if layout == "ticker":
        out = bars.select(*cols).repartitionByRange(TICKER, DATE).sortWithinPartitions(TICKER, DATE)
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(TICKER).parquet(path)
    elif layout == "month":
        out = (
            bars.select(*cols, F.date_format(DATE, "yyyy-MM").alias("month"))
            .repartitionByRange("month", TICKER, DATE)
            .sortWithinPartitions("month", TICKER, DATE)
        )
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return path


_READ_SCHEMA = T.StructType(BARS.fields + [T.StructField("month", T.StringType(), True)])


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Either layout, with an explicit schema (no type inference from directory names, so a
    ticker such as ``007`` stays a string); the month partition column is dropped after pruning.
    A stored NaN reads as null: the operators know one kind of missing value."""
    rows = spark.read.schema(_READ_SCHEMA).parquet(path)
    return rows.select(*[nan_to_null(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "double" else f.name for f in BARS.fields])


def load_ticker(spark: SparkSession, path: str, ticker: str) -> DataFrame:
    """S3: one ticker via partition pruning; an absent ticker is ``FileNotFoundError``."""
    df = read_bars(spark, path).where(F.col(TICKER) == ticker)
    if not df.limit(1).collect():
        raise FileNotFoundError(f"the bar table {path} lacks ticker {ticker!r}")
    return df


def load_all(spark: SparkSession, path: str, tickers: list[str], ordered: bool = False) -> DataFrame:
    """Several tickers (pruned scan); any missing ticker is an error.

    ``ordered=True`` returns rows sorted by (ticker, date) like the reference's concatenated
    frame: a range-partitioned global sort, so it scales, but only worth it when the output
    order is consumed (every operator here states its own order).
    """
    df = read_bars(spark, path).where(F.col(TICKER).isin(tickers))
    present = {r[TICKER] for r in df.select(TICKER).distinct().collect()}  # at most len(tickers) rows
    missing = [t for t in tickers if t not in present]
    if missing:
        raise FileNotFoundError(f"the bar table {path} lacks ticker {missing[0]!r}")
    return df.orderBy(TICKER, DATE) if ordered else df


def stage(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write a derived table once to the shared scratch folder and read it back.

    Used for bars derived from raw tables: later operators scan it (cheap, column-pruned,
    deterministic) instead of recomputing the aggregate per pass, and it cuts lineage.
    """
    from barspark.session import materialize

    return materialize(df, name)
