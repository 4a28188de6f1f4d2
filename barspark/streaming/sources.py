"""Streaming bar source (S12 / ST1): a Structured Streaming file source with the bar schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barspark.schemas import BARS


#: Bytes of bar files that one micro-batch takes at most (a larger file is one by itself): bounds what a ticker's
#: state update holds, however many files have arrived.
BATCH_BYTES = 1 << 30


def bar_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_bytes: int = BATCH_BYTES) -> DataFrame:
    """Bars as they arrive as files; a micro-batch takes ``max_files_per_trigger`` files, or ``max_bytes`` where no count is given."""
    reader = spark.readStream.schema(BARS).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.load(path)


def run_available_now(stream_df: DataFrame, sink_path: str, checkpoint: str, mode: str = "append") -> None:
    """Drain everything currently available into a Parquet sink (exactly once via the checkpoint)."""
    q = (
        stream_df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise RuntimeError(str(q.exception()))
