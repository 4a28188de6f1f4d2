"""Counters on a stream (A10, A11): running totals by key in ``update`` mode, behind a sink that replays can't spoil.

Spark's state holds one total per key.  An epoch's folder of the sink has the new totals of the keys that changed in it, so
writing it again leaves the same values; a key's total is that of its newest epoch.  Every ``COMPACT`` epochs the
totals of all keys are written as one folder and the epochs before it go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.sources import fsutil

COMPACT = 64


def _numbers(spark: SparkSession, folder: str, prefix: str, finished: bool = False) -> list[int]:
    found = [int(n[len(prefix) :]) for n in fsutil.list_names(spark, folder) if n.startswith(prefix)]
    return sorted(n for n in found if not finished or fsutil.exists(spark, fsutil.join(folder, f"{prefix}{n}", "_SUCCESS")))


def _whole(sink_path: str) -> str:
    return f"{sink_path.rstrip('/')}_whole"


def read_totals(spark: SparkSession, sink_path: str, keys: list[str], name: str) -> DataFrame:
    """``keys, name``: the newest total of every key."""
    whole = _numbers(spark, _whole(sink_path), "epoch=", finished=True)
    later = [n for n in _numbers(spark, sink_path, "epoch=", finished=True) if not whole or n > whole[-1]]
    paths = [fsutil.join(_whole(sink_path), f"epoch={whole[-1]}")] if whole else []
    paths += [fsutil.join(sink_path, f"epoch={n}") for n in later]
    if not paths:
        raise FileNotFoundError(f"no totals under {sink_path}")
    rows = spark.read.parquet(*paths)
    return rows.groupBy(*keys).agg(F.max_by(name, "_epoch").alias(name))


def _compact(spark: SparkSession, sink_path: str, keys: list[str], name: str, epoch: int) -> None:
    target = fsutil.join(_whole(sink_path), f"epoch={epoch}")
    if not fsutil.exists(spark, fsutil.join(target, "_SUCCESS")):  # a replay finds it written
        totals = read_totals(spark, sink_path, keys, name).withColumn("_epoch", F.lit(epoch).cast("bigint"))
        totals.write.mode("overwrite").parquet(target)
    for n in _numbers(spark, sink_path, "epoch="):
        if n < epoch:
            fsutil.remove(spark, fsutil.join(sink_path, f"epoch={n}"))
    for n in _numbers(spark, _whole(sink_path), "epoch="):
        if n < epoch:
            fsutil.remove(spark, fsutil.join(_whole(sink_path), f"epoch={n}"))


def stream_totals(
    stream: DataFrame, keys: list[str], name: str, sink_path: str, checkpoint: str, where: Column | None = None, available_now: bool = True, compact: int = COMPACT
):
    """Count the rows (that ``where`` holds for) by key for as long as the stream runs; returns the StreamingQuery."""
    rows = stream if where is None else stream.where(where)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))

    def each(batch: DataFrame, epoch: int) -> None:
        changed = batch.withColumn("_epoch", F.lit(epoch).cast("bigint"))
        changed.write.mode("overwrite").parquet(fsutil.join(sink_path, f"epoch={epoch}"))
        if epoch % compact == compact - 1:
            _compact(batch.sparkSession, sink_path, keys, name, epoch)

    writer = counts.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    q = (writer.trigger(availableNow=True) if available_now else writer).start()
    if available_now:
        q.awaitTermination()
    return q
