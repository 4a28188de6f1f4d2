"""Online features on a stream (ST3).

Spark's state store holds each ticker's last bars and the numbers of its recursive features
(:mod:`barspark.streaming.state`).  A micro-batch is the new bars and the held ones of their tickers: the windows over them
are the offline Column builders, the recursive features come from the state, so stream results equal the offline table
and a batch's work grows with its new bars alone.

Each epoch's rows are a folder of the sink, written again when the epoch is retried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspark.functions.features import FeatureSet
from barspark.operators.features import compute_features
from barspark.schemas import DATE, PRICE_COLUMNS, TICKER
from barspark.sources import fsutil
from barspark.streaming.state import LATE, NEW, with_tails

EPOCHS_PER_RUN = 1 << 40


def run_number(spark: SparkSession, state_root: str, checkpoint: str) -> int:
    """Number of the query that a checkpoint belongs to, among all that wrote to this sink (0, 1, ...).

    Epochs restart at 0 under a new checkpoint; numbering them after the earlier queries' keeps the sink one sequence.
    """
    names = [n for n in fsutil.list_names(spark, state_root) if n.startswith("RUN-")]
    runs = {int(n[4:]): fsutil.read_text(spark, fsutil.join(state_root, n)) for n in names}
    for number, owner in runs.items():
        if owner == checkpoint.rstrip("/"):
            return number
    number = max(runs, default=-1) + 1
    fsutil.create_text(spark, fsutil.join(state_root, f"RUN-{number}"), checkpoint.rstrip("/"))
    return number


def late_path(sink_path: str) -> str:
    """Side table of :func:`stream_features`: ``ticker, late_rows`` of each epoch."""
    return f"{sink_path.rstrip('/')}_late"


def _last_dates(spark: SparkSession, sink_path: str, state_root: str, run: int) -> DataFrame | None:
    """``ticker, _last``: the newest date that earlier queries put into the sink, written once when a new query starts."""
    if not run:
        return None
    path = fsutil.join(state_root, f"known-{run}")
    if not fsutil.exists(spark, fsutil.join(path, "_SUCCESS")):
        if not fsutil.exists(spark, sink_path):
            return None
        earlier = spark.read.parquet(sink_path).where(F.col("epoch") < run * EPOCHS_PER_RUN)
        earlier.groupBy(TICKER).agg(F.max(DATE).alias("_last")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def batch_features(batch: DataFrame, fs: FeatureSet, keep: list[str] | None = None) -> DataFrame:
    """``ticker, date, *keep, *features`` of a micro-batch's new bars (rows of :func:`with_tails`); warm-up rows have nulls."""
    recursive = [f.name for f in fs.recursive_features]
    own = [TICKER, DATE, *PRICE_COLUMNS, NEW, *recursive]
    # held bars and new ones lie apart in time; a date that repeats among the new ones keeps its first bar
    pick = Window.partitionBy(TICKER, DATE).orderBy(*[F.col(c).asc_nulls_last() for c in PRICE_COLUMNS])
    rows = batch.where(F.col(NEW).isNotNull()).select(*own).withColumn("_pick", F.row_number().over(pick)).where("_pick = 1").drop("_pick")
    feats = compute_features(rows, fs.without_recursive(), keep=[NEW, *(keep or []), *recursive], dropna=False)
    return feats.where(F.col(NEW)).select(TICKER, DATE, *(keep or []), *fs.feature_names)


def late_rows(batch: DataFrame) -> DataFrame:
    """``ticker, late_rows`` of a micro-batch: bars not after the newest held one, and repeats."""
    shown = batch.where(F.col(NEW)).groupBy(TICKER, DATE).agg((F.count(F.lit(1)) - 1).alias("late_rows"))
    told = batch.where(F.col(NEW).isNull()).select(TICKER, F.col(LATE).alias("late_rows"))
    return shown.select(TICKER, "late_rows").unionByName(told).groupBy(TICKER).agg(F.sum("late_rows").alias("late_rows")).where("late_rows > 0")


def stream_features(
    stream: DataFrame,
    fs: FeatureSet,
    sink_path: str,
    state_root: str,
    checkpoint: str,
    available_now: bool = True,
    on_features: Callable[[DataFrame, int], None] | None = None,
):
    """Start the ST3 query; returns the StreamingQuery (already finished when ``available_now``).

    ``on_features(rows, epoch)`` gets all new bars of an epoch with their features (null in the warm-up), after
    the sink has them.  Late and repeated rows are counted per ticker and epoch in the side table :func:`late_path`.
    State lives with the checkpoint.  Under a new checkpoint the source is read again from its start to
    rebuild it: bars up to the newest that the sink has are counted as late and not written again (``state_root``
    keeps which checkpoints wrote to the sink).
    """
    run = run_number(stream.sparkSession, state_root, checkpoint)
    first = run * EPOCHS_PER_RUN
    known = _last_dates(stream.sparkSession, sink_path, state_root, run)
    tails = with_tails(stream, fs.without_recursive().lookback, fs.recursive_features)

    def each(batch: DataFrame, epoch_id: int) -> None:
        epoch = first + epoch_id
        # several plans read the micro-batch; kept, the stateful step runs once (lost blocks are computed again)
        batch = batch.persist()
        try:
            feats, late = batch_features(batch, fs), late_rows(batch)
            if known is not None:
                marked = feats.join(known, TICKER, "left").withColumn("_again", F.coalesce(F.col(DATE) <= F.col("_last"), F.lit(False)))
                again = marked.where("_again").groupBy(TICKER).agg(F.count(F.lit(1)).alias("late_rows"))
                late = late.unionByName(again).groupBy(TICKER).agg(F.sum("late_rows").alias("late_rows"))
                feats = marked.where("not _again").drop("_last", "_again")
            feats = feats.persist()
            # one directory per epoch, overwritten on a retry: the sink stays exactly-once
            feats.dropna(subset=fs.feature_names).write.mode("overwrite").parquet(fsutil.join(sink_path, f"epoch={epoch}"))
            late.write.mode("overwrite").parquet(fsutil.join(late_path(sink_path), f"epoch={epoch}"))
            if on_features is not None:
                on_features(feats, epoch)
            feats.unpersist()
        finally:
            batch.unpersist()

    writer = tails.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q
