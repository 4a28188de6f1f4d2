"""Prediction log as an append-only JSON table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.schemas import PREDICTION_LOG
from barspark.sources import fsutil


def append_predictions(predictions: DataFrame, path: str, epoch: int | None = None) -> str:
    """Append ``ticker, prediction_date, direction, probability, model_version`` with a UTC
    ISO timestamp (one value per query, like ``current_timestamp``); probability unrounded.

    With an ``epoch`` the rows are that epoch's folder of the log, replaced when the epoch is retried.
    One log is written either with epochs or without."""
    utc_now = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    out = predictions.select(
        F.date_format(utc_now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        "ticker",
        "prediction_date",
        "direction",
        F.col("probability").cast("double").alias("probability"),
        F.col("model_version").cast("string").alias("model_version"),
    )
    if epoch is None:
        out.write.mode("append").json(path)
    else:
        out.write.mode("overwrite").json(fsutil.join(path, f"epoch={epoch}"))
    return path


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Missing log -> empty frame; blank lines ignored; malformed JSON fails the job."""
    if not fsutil.exists(spark, path):
        return spark.createDataFrame([], PREDICTION_LOG)
    return spark.read.schema(PREDICTION_LOG).option("mode", "FAILFAST").json(path).select(*PREDICTION_LOG.names)
