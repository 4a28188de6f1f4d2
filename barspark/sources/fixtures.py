"""Adapters from the given test tables to bar-shaped inputs (FIXTURES.md part 2).

All of them are aggregates or projections over the whole input table, so their work grows with it.
Every aggregate is a partial (map-side) + final hash aggregate: a hot ticker-hour is combined
inside each map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.functions.columns import hour_floor
from barspark.operators.sequence import SEQ
from barspark.schemas import DATE, TICKER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bars_from_events(events: DataFrame) -> DataFrame:
    """Hourly OHLCV bars per ``event_type``; ``arrival`` = first ``event_id`` of the bar."""
    order = F.struct("ts", "event_id")
    return (
        events.select("event_id", "ts", "event_type", "value")
        .groupBy(
            F.col("event_type").alias(TICKER),
            hour_floor(F.col("ts").cast("timestamp_ntz")).alias(DATE),
        )
        .agg(
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("double").alias("volume"),
            F.min("event_id").alias("arrival"),
        )
    )


def bars_events(spark: SparkSession, sf_dir: str, with_arrival: bool = False) -> DataFrame:
    bars = bars_from_events(table(spark, sf_dir, "events"))
    cols = [TICKER, DATE, "open", "high", "low", "close", "volume"] + (["arrival"] if with_arrival else [])
    return bars.select(*cols)


def bars_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide panel: daily bars per supplier from ``lineitem`` on ship date."""
    li = table(spark, sf_dir, "lineitem")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return (
        li.select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("timestamp_ntz").alias(DATE))
        .agg(
            F.min_by("l_extendedprice", order).alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max_by("l_extendedprice", order).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
        # the key becomes text after the grouping: numbers are shorter to sort and move
        .select(F.col("l_suppkey").cast("string").alias(TICKER), DATE, "open", "high", "low", "close", "volume")
    )


def prediction_log(bars: DataFrame, return_col: str = "return_1d") -> DataFrame:
    """A prediction log derived from bars that carry ``return_1d`` and ``_seq`` (position in ticker).

    prediction_date = bar date + 30 min x (position mod 4): exact hit, tie (later bar wins),
    next bar, tie one later.  Every 50th position has no date; every 97th names a ticker
    without bars.
    """
    pos = F.col(SEQ)
    when_logged = F.col(DATE) + F.make_dt_interval(F.lit(0), F.lit(0), (pos % 4) * 30)
    return bars.where(F.col(return_col).isNotNull()).select(
        F.lit("2024-02-01T00:00:00+00:00").alias("timestamp"),
        F.when(pos % 97 == 0, F.concat(F.col(TICKER), F.lit("_unlisted"))).otherwise(F.col(TICKER)).alias(TICKER),
        F.when(pos % 50 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format(when_logged, "yyyy-MM-dd HH:mm:ss"))
        .alias("prediction_date"),
        F.when(F.col(return_col) > 0, F.lit("UP")).otherwise(F.lit("DOWN")).alias("direction"),
        ((pos * 37) % 100 / F.lit(100.0)).alias("probability"),
        (pos % 3).cast("string").alias("model_version"),
    )


def bars_with_returns(bars: DataFrame) -> DataFrame:
    """Bars + ``_seq`` + one-row return (helper for the log and score adapters)."""
    from barspark.functions.columns import ratio_change
    from barspark.operators.sequence import chunk_window, core_only, frame, position

    rows = frame(bars, [TICKER], [DATE], back=1)
    w = chunk_window([TICKER], [DATE])
    rows = rows.withColumn("return_1d", ratio_change(F.col("close"), F.lag("close", 1).over(w)))
    rows = rows.withColumn(SEQ, position([TICKER], [DATE]))
    return core_only(rows)


def runs_from_events(events: DataFrame) -> DataFrame:
    """One training run per (event_type, day): roc_auc from exact integer cents, run order = day."""
    day = F.to_date(F.col("ts"))
    per_day = events.groupBy(F.col("event_type").alias("model"), day.alias("day")).agg(
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    )
    return per_day.select(
        F.concat_ws("-", F.col("model"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
        "model",
        F.unix_date("day").cast("long").alias("run_seq"),
        (F.lit(0.5) + (F.col("cents") % 997) / F.lit(19940.0)).alias("roc_auc"),
        F.lit(False).alias("dry_run"),
    )
