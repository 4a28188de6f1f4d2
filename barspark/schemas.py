"""Explicit schemas and key names used at every source boundary."""

from pyspark.sql import types as T

TICKER = "ticker"
DATE = "date"
PRICE_COLUMNS = ["open", "high", "low", "close", "volume"]
KEYS = [TICKER]

BARS = T.StructType(
    [
        T.StructField(TICKER, T.StringType(), False),
        T.StructField(DATE, T.TimestampNTZType(), False),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("volume", T.DoubleType(), True),
    ]
)

# One logged prediction (JSON lines); prediction_date is an ISO string as written by the scorer.
PREDICTION_LOG = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), True),
        T.StructField(TICKER, T.StringType(), True),
        T.StructField("prediction_date", T.StringType(), True),
        T.StructField("direction", T.StringType(), True),
        T.StructField("probability", T.DoubleType(), True),
        T.StructField("model_version", T.StringType(), True),
    ]
)

TRAINING_STATS = T.StructType(
    [
        T.StructField("feature", T.StringType(), False),
        T.StructField("mean", T.DoubleType(), True),
        T.StructField("std", T.DoubleType(), True),
    ]
)

# Append-only run log: the registry (versions, champion alias) is derived from it.
RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("run_seq", T.LongType(), False),
        T.StructField("roc_auc", T.DoubleType(), True),
        T.StructField("dry_run", T.BooleanType(), False),
        T.StructField("model_path", T.StringType(), True),
        T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    ]
)
