"""Skew-safe ordered sequences per key.

Every bar operator in this package is a function of a row's neighbours *in time order within
one ticker* (lags, rolling frames, leads, EMAs, as-of lookups).  The obvious Spark form is
``Window.partitionBy("ticker").orderBy("date")``, which puts a whole ticker into one task: one
ticker holding a third of the rows would make that single task a third of the job.

Instead:

1. :func:`sequence` gives each row its dense 0-based position ``_seq`` within its key.  It
   range-partitions on ``(keys, order)`` (so a hot key is cut into many contiguous slices),
   sorts inside each partition, numbers rows with ``monotonically_increasing_id`` and turns
   (partition, local id) into a per-key position with a small offsets table.
2. :func:`chunk` cuts each key into fixed-size chunks of ``chunk_rows`` positions and copies
   the ``back`` rows before / ``fwd`` rows after each chunk into it as a halo, so any window
   with a bounded look-back/look-ahead is computed exactly inside
   ``Window.partitionBy(keys, _chunk)``; halo rows are dropped afterwards (``_core``).

Both steps are plain DataFrame operations: one range exchange, one small aggregate, one hash
exchange on ``(keys, _chunk)``.  Task size is bounded by ``chunk_rows + back + fwd`` no matter
how the rows spread over keys.

:func:`frame` applies this only where it is needed: one grouped count (partial aggregation, one
row per key) finds the *hot* keys, those with more rows than a chunk.  Ordinary keys are one
chunk each (``_chunk = 0``, no halo, no range shuffle); hot keys go through sequence + chunk.
Both parts are unioned and windowed together by ``partitionBy(keys, _chunk)``, so every window
task is bounded either way and the common case costs a single hash shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspark.functions.features import BASELINE_COLUMNS
from barspark.schemas import DATE
from barspark.session import materialize, shuffle_partitions

SEQ = "_seq"
CHUNK = "_chunk"
CORE = "_core"
COUNT = "_count"

# Rows per chunk.  ~100 bytes per bar -> ~100 MB per window task at the default.
DEFAULT_CHUNK_ROWS = 1 << 20
# Rows of one task of a window stage.  A larger table is dealt over as many partitions as that takes, whatever
# the session's shuffle partitions and the sizes to which adaptive execution joins them.
TASK_ROWS = 1 << 18
# A side table is broadcast only when its rows, at its columns' width, take at most this.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, rows: int, limit: int | None = None, text: int | None = None) -> DataFrame:
    """Broadcast hint only behind a measured size; otherwise leave the join to shuffle.

    ``text``: the measured bytes of all its strings; without them a string counts as 64 bytes.
    """
    width = sum(text is None and f.dataType.jsonValue() == "string" and 64 or 16 for f in df.schema.fields)
    return F.broadcast(df) if rows * width + (text or 0) <= (BROADCAST_BYTES if limit is None else limit) else df


def task_partitions(spark, rows: int) -> int | None:
    """Partitions of about ``TASK_ROWS`` rows each; ``None`` for a table that one task holds."""
    if rows <= TASK_ROWS:
        return None
    return max(-(-rows // TASK_ROWS), min(shuffle_partitions(spark), spark.sparkContext.defaultParallelism))


@dataclass
class Sequenced:
    """Rows with ``_seq`` plus the row count of every key (``keys`` + ``_count``)."""

    rows: DataFrame
    totals: DataFrame
    keys: list[str]


def sequence(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> Sequenced:
    """Number the rows of each key 0..n-1 in ``order`` (which must be unique within a key)."""
    spark = df.sparkSession
    n = partitions or shuffle_partitions(spark)
    sort_cols = [*keys, *order]
    # An explicit partition count keeps AQE from coalescing, so `_pid` is stable.
    tagged = (
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # The ids depend on partition layout: write them once to the shared checkpoint folder so
    # both branches below (and any recomputation after a lost executor) read identical values.
    tagged = materialize(tagged, "sequence")

    groups = tagged.groupBy("_pid", *keys).agg(
        F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per (partition, key) run: partitions + keys rows.  Written (not cached) so
    # it survives executor loss and never pins executor memory in a long-lived session.
    offsets = materialize(
        groups.select(
            "_pid",
            *keys,
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_m0")).alias("_base"),
            F.sum("_n").over(Window.partitionBy(*keys)).alias(COUNT),
        ),
        "sequence-offsets",
    )
    # A run a key at least: the keys' real lengths decide whether they fit (a shuffle join would move and sort all rows).
    lengths = [F.coalesce(F.octet_length(k), F.lit(0)) for k in keys if offsets.schema[k].dataType.typeName() == "string"]
    n_offsets, text = offsets.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(lengths, F.lit(0))), F.lit(0))).first()
    rows = (
        tagged.join(broadcast_if_small(offsets.drop(COUNT), n_offsets, text=text), ["_pid", *keys])
        .withColumn(SEQ, F.col("_mid") + F.col("_base"))
        .drop("_pid", "_mid", "_base")
    )
    totals = offsets.select(*keys, COUNT).distinct()
    return Sequenced(rows=rows, totals=totals, keys=list(keys))


def row_numbers(ordered: DataFrame, name: str = "row_no") -> DataFrame:
    """The rows numbered from 0 in the order that they have (that of a global sort).

    The order is written once, each row with its place in its partition; one number a partition comes to the driver.
    """
    spark = ordered.sparkSession
    placed = materialize(ordered.withColumn("_mid", F.monotonically_increasing_id()), "ordered")
    part, low = F.shiftright("_mid", 33), F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    starts, at = [], 0
    for p, n in sorted(placed.groupBy(part.alias("p")).count().collect()):
        starts.append((p, at))
        at += n
    offsets = spark.createDataFrame(starts or [(0, 0)], "_part bigint, _start bigint")
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # one row a partition
    return joined.withColumn(name, F.col("_start") + low).drop("_mid", "_part", "_start")


def chunk(rows: DataFrame, back: int = 0, fwd: int = 0, chunk_rows: int | None = None) -> DataFrame:
    """Assign ``_chunk`` and copy halo rows into neighbouring chunks; ``_core`` marks owned rows."""
    size = max(chunk_rows or DEFAULT_CHUNK_ROWS, back, fwd, 1)
    own = F.floor(F.col(SEQ) / F.lit(size))
    pos = F.col(SEQ) - own * F.lit(size)
    targets = F.filter(
        F.array(
            own,
            F.when(pos >= F.lit(size - back), own + 1) if back > 0 else F.lit(None).cast("long"),
            F.when((pos < F.lit(fwd)) & (own > 0), own - 1) if fwd > 0 else F.lit(None).cast("long"),
        ),
        lambda x: x.isNotNull(),
    )
    return (
        rows.withColumn("_own", own)
        .withColumn(CHUNK, F.explode(targets))
        .withColumn(CORE, F.col(CHUNK) == F.col("_own"))
        .drop("_own")
    )


def chunk_window(keys: list[str], order: list[str] | None = None) -> Window:
    """Window over one chunk (with its halo) in time order."""
    return Window.partitionBy(*keys, CHUNK).orderBy(*(order or [SEQ]))


def time_order(bars: DataFrame, time: str = DATE) -> list[str]:
    """Total order of a ticker's bars: time, then arrival where known, then the values.  Bars that repeat
    a time come in one order under any partitioning (rows equal in all of these are interchangeable)."""
    return [time, *[c for c in ("arrival", *BASELINE_COLUMNS) if c in bars.columns]]


# Above this many hot keys, every key takes the chunked path (no key list on the driver).  A setting
# may lower it, not raise it: the list is broadcast.
MAX_HOT_KEYS = 10_000

# Session settings a cluster user can tune without code changes.
CHUNK_ROWS_CONF = "spark.barspark.chunkRows"
MAX_HOT_KEYS_CONF = "spark.barspark.maxHotKeys"


def configured_chunk_rows(spark) -> int:
    value = spark.conf.get(CHUNK_ROWS_CONF, None)
    return int(value) if value else DEFAULT_CHUNK_ROWS


def configured_max_hot_keys(spark) -> int:
    value = spark.conf.get(MAX_HOT_KEYS_CONF, None)
    return min(int(value), MAX_HOT_KEYS) if value else MAX_HOT_KEYS


def hot_keys(df: DataFrame, keys: list[str], rows: int) -> list[tuple] | None:
    """Keys with more than ``rows`` rows; ``None`` when there are too many to list."""
    return _measured(df, keys, rows)[0]


def _measured(df: DataFrame, keys: list[str], rows: int) -> tuple[list[tuple] | None, int]:
    """:func:`hot_keys` and the rows of the table."""
    if not keys:
        n = df.count()
        return (None if n > rows else []), n
    cap = configured_max_hot_keys(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n, hot = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count_if(F.col("_n") > rows)).first()
    if hot > cap:
        return None, n
    listed = counts.where(F.col("_n") > rows).select(*keys).collect() if hot else []  # at most `cap` rows
    return [tuple(r) for r in listed], n


def frame(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    back: int = 0,
    fwd: int = 0,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Rows with ``_chunk``/``_core`` (and ``_seq`` for hot keys) ready for :func:`chunk_window`.

    Window with ``chunk_window(keys, order)`` and keep ``_core`` rows at the end.  A table beyond one task comes
    dealt over :func:`task_partitions` by (keys, chunk), so that the windows need no exchange of their own.
    """
    size = max(chunk_rows or configured_chunk_rows(df.sparkSession), back, fwd, 1)
    hot, total = _measured(df, keys, size)
    halo = 0 if hot == [] else total * (back + fwd) // size
    n = task_partitions(df.sparkSession, total + halo)

    def ordinary(part: DataFrame) -> DataFrame:
        return part.withColumns(
            {SEQ: F.lit(None).cast("long"), CHUNK: F.lit(0).cast("long"), CORE: F.lit(True)}
        )

    def chunked(part: DataFrame) -> DataFrame:
        return chunk(sequence(part, keys, order, partitions=n).rows, back=back, fwd=fwd, chunk_rows=size)

    if hot == []:
        out = ordinary(df)
    elif hot is None:
        out = chunked(df)
    else:
        spark = df.sparkSession
        hot_df = F.broadcast(spark.createDataFrame(hot, df.select(*keys).schema))  # <= maxHotKeys rows
        out = ordinary(df.join(hot_df, keys, "left_anti")).unionByName(chunked(df.join(hot_df, keys, "left_semi")))
    if n and (keys or hot is None):
        # where a key is one chunk, its number is a constant that the windows' partitioning drops
        out = out.repartition(n, *keys, *([] if hot == [] else [CHUNK]))
    out._barspark_partitions, out._barspark_sequenced = n, hot is None
    out._barspark_single_chunk = hot == []  # every key is one chunk: no cross-chunk carry needed
    return out


def position(keys: list[str], order: list[str]) -> Column:
    """0-based position within the key: ``_seq`` for hot keys, row number for one-chunk keys."""
    return F.coalesce(F.col(SEQ), F.row_number().over(chunk_window(keys, order)) - 1)


def core_only(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORE)).drop(CORE, CHUNK)


def prefix_sum(chunked: DataFrame, keys: list[str], weight: Column, out: str, order: list[str] | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` per key in sequence order, exact across chunks.

    Within a chunk: a running window over owned rows.  Across chunks: a small table of per-chunk
    totals (one row per chunk) turned into offsets and joined back.
    """
    w = chunk_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    owned = F.when(F.col(CORE), weight).otherwise(F.lit(0))
    local = chunked.withColumn("_local", F.sum(owned).over(w))
    if getattr(chunked, "_barspark_single_chunk", False):
        return local.withColumnRenamed("_local", out)
    per_chunk = (
        chunked.where(F.col(CORE))
        .groupBy(*keys, CHUNK)
        .agg(F.sum(weight).alias("_tot"))
    )
    prev = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offs = materialize(
        per_chunk.select(*keys, CHUNK, F.coalesce(F.sum("_tot").over(prev), F.lit(0)).alias("_off")),
        "prefix-offsets",
    )
    n_offs = offs.count()
    return (
        local.join(broadcast_if_small(offs, n_offs), [*keys, CHUNK], "left")
        .withColumn(out, F.col("_local") + F.coalesce(F.col("_off"), F.lit(0)))
        .drop("_local", "_off")
    )
