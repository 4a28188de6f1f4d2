"""Back-evaluation of logged predictions against realised prices.

For each log row: the bar nearest to ``prediction_date`` within the same ticker (no tolerance;
before the first bar -> first bar, after the last -> last; a tie goes to the later bar), then
the close ``forward`` bars later.  Status: ``skipped`` (no date / no bars), ``pending`` (not
enough later bars) or ``evaluated``.

Nearest as-of without a per-ticker task: bars and log rows are put in one time order per
ticker; a running count of bars (prefix sum, chunked) gives each log row ``k`` = bars at or
before it.  The candidates are bar ``k-1`` and bar ``k``, both carried by gap row ``k`` of
:func:`bar_gaps`: one equi-join on (ticker, k), a key that is unique per gap, so a hot ticker
spreads over all its gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.functions.columns import micros_between
from barspark.operators.sequence import SEQ, chunk_window, core_only, frame, position, prefix_sum
from barspark.schemas import DATE, TICKER

# Fixed value that must equal the reference's: trading rows between prediction and outcome.
FORWARD_DAYS = 5


def bar_gaps(bars: DataFrame, forward: int = FORWARD_DAYS) -> DataFrame:
    """One row per gap ``k`` between consecutive bars of a ticker (``k`` = bars before the gap).

    Gap ``k`` carries bar ``k-1`` (``_p*``: previous) and bar ``k`` (``_n*``: next), each with its
    index, date, close, the close ``forward`` bars later and whether that bar exists.  Gap 0 has
    no previous bar, the gap after the last bar has no next bar.  Built in the same bounded-window
    pass (``lag``/``lead`` with a one-row / ``forward``-row halo), so an as-of lookup is then a
    single equi-join on (ticker, k).
    """
    order = [DATE, "close"]
    rows = frame(bars.select(TICKER, DATE, "close"), [TICKER], order, back=1, fwd=forward)
    w = chunk_window([TICKER], order)
    rows = rows.withColumns(
        {
            "_i": position([TICKER], order),
            "_f": F.lead("close", forward).over(w),
            "_has_f": F.lead(DATE, forward).over(w).isNotNull(),
            "_pd": F.lag(DATE, 1).over(w),
            "_pc": F.lag("close", 1).over(w),
            "_pf": F.lead("close", forward - 1).over(w),
            "_has_pf": F.lead(DATE, forward - 1).over(w).isNotNull(),
            "_last": F.lead(DATE, 1).over(w).isNull(),
        }
    )
    core = core_only(rows)
    null_ts, null_d, null_b, null_l = (
        F.lit(None).cast("timestamp_ntz"),
        F.lit(None).cast("double"),
        F.lit(None).cast("boolean"),
        F.lit(None).cast("long"),
    )
    inner = core.select(
        TICKER,
        F.col("_i").alias("_k"),
        F.when(F.col("_i") > 0, F.col("_i") - 1).alias("_pi"),
        "_pd",
        "_pc",
        F.when(F.col("_i") > 0, F.col("_pf")).alias("_pf"),
        F.when(F.col("_i") > 0, F.col("_has_pf")).alias("_has_pf"),
        F.col("_i").alias("_ni"),
        F.col(DATE).alias("_nd"),
        F.col("close").alias("_nc"),
        F.col("_f").alias("_nf"),
        F.col("_has_f").alias("_has_nf"),
    )
    after_last = core.where(F.col("_last")).select(
        TICKER,
        (F.col("_i") + 1).alias("_k"),
        F.col("_i").alias("_pi"),
        F.col(DATE).alias("_pd"),
        F.col("close").alias("_pc"),
        F.col("_f").alias("_pf"),
        F.col("_has_f").alias("_has_pf"),
        null_l.alias("_ni"),
        null_ts.alias("_nd"),
        null_d.alias("_nc"),
        null_d.alias("_nf"),
        null_b.alias("_has_nf"),
    )
    return inner.unionByName(after_last)


def _log_times(log: DataFrame) -> DataFrame:
    d = F.trim(F.col("prediction_date"))
    return log.withColumn("_has_date", F.coalesce(d, F.lit("")) != "").withColumn(
        "_t", F.when(F.col("_has_date"), F.to_timestamp_ntz(d))
    )


def evaluate_predictions(log: DataFrame, bars: DataFrame, forward: int = FORWARD_DAYS) -> DataFrame:
    """Every log row with ``status`` and, when evaluated, the realised outcome (D2 + D3)."""
    log = _log_times(log)
    dated = log.where(F.col("_has_date"))
    payload = [c for c in log.columns if c not in (TICKER, "_has_date", "_t")]

    # one time order per ticker: bars before log rows at an equal time; k = bars at or before
    bars_u = bars.select(
        TICKER,
        F.col(DATE).alias("_t"),
        F.lit(0).alias("_kind"),
        *[F.lit(None).cast(log.schema[c].dataType).alias(c) for c in payload],
    )
    log_u = dated.select(TICKER, "_t", F.lit(1).alias("_kind"), *payload)
    order = ["_t", "_kind"]
    both = frame(bars_u.unionByName(log_u), [TICKER], order)
    rows = prefix_sum(both, [TICKER], (F.col("_kind") == 0).cast("long"), "_k", order)
    placed = core_only(rows).where(F.col("_kind") == 1).drop("_kind", SEQ)

    # the two candidates (bar k-1, bar k) come from one gap row: a single equi-join
    cand = placed.join(bar_gaps(bars, forward), [TICKER, "_k"], "left")
    d_prev = micros_between(F.col("_pd"), F.col("_t"))  # wall-clock distances, time-zone free
    d_next = micros_between(F.col("_t"), F.col("_nd"))
    take_next = F.col("_nd").isNotNull() & (F.col("_pd").isNull() | (d_next <= d_prev))
    chosen = cand.select(
        TICKER,
        *payload,
        F.when(take_next, F.col("_ni")).otherwise(F.col("_pi")).alias("bar_index"),
        F.when(take_next, F.col("_nd")).otherwise(F.col("_pd")).alias("bar_date"),
        F.when(take_next, F.col("_nc")).otherwise(F.col("_pc")).alias("close_t_raw"),
        F.when(take_next, F.col("_nf")).otherwise(F.col("_pf")).alias("close_forward_raw"),
        F.when(take_next, F.col("_has_nf")).otherwise(F.col("_has_pf")).alias("_has_forward"),
    )
    undated = log.where(~F.col("_has_date")).select(
        TICKER,
        *payload,
        F.lit(None).cast("long").alias("bar_index"),
        F.lit(None).cast("timestamp_ntz").alias("bar_date"),
        F.lit(None).cast("double").alias("close_t_raw"),
        F.lit(None).cast("double").alias("close_forward_raw"),
        F.lit(None).cast("boolean").alias("_has_forward"),
    )
    allrows = chosen.unionByName(undated)
    status = (
        F.when(F.col("bar_index").isNull(), F.lit("skipped"))
        .when(~F.col("_has_forward"), F.lit("pending"))
        .otherwise(F.lit("evaluated"))
    )
    evaluated = status == "evaluated"
    realized = F.when(evaluated, F.when(F.col("close_forward_raw") > F.col("close_t_raw"), "UP").otherwise("DOWN"))
    return allrows.select(
        TICKER,
        *payload,
        status.alias("status"),
        F.col("bar_date"),
        F.col("direction").alias("predicted"),
        realized.alias("realized"),
        F.when(evaluated, F.col("direction") == realized).alias("correct"),
        F.when(evaluated, F.round("close_t_raw", 4)).alias("close_t"),
        F.when(evaluated, F.round("close_forward_raw", 4)).alias("close_forward"),
    )


def prediction_results(evaluated: DataFrame) -> DataFrame:
    """The detail rows of evaluated predictions."""
    return evaluated.where(F.col("status") == "evaluated").select(
        TICKER, "prediction_date", "predicted", "realized", "correct", "probability", "close_t", "close_forward"
    )


def prediction_summary(evaluated: DataFrame) -> DataFrame:
    """evaluated / pending / skipped counts and accuracy rounded to 4 (0.0 when none evaluated)."""
    out = evaluated.agg(
        F.count_if(F.col("status") == "evaluated").alias("evaluated"),
        F.count_if(F.col("status") == "pending").alias("pending"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.count_if(F.col("correct")).alias("_correct"),
    )
    acc = F.coalesce(F.try_divide(F.col("_correct").cast("double"), F.col("evaluated").cast("double")), F.lit(0.0))
    return out.select("evaluated", "pending", "skipped", F.round(acc, 4).alias("accuracy"))


def predictions_total(log: DataFrame) -> DataFrame:
    """A10: predictions by (ticker, direction)."""
    return log.groupBy(TICKER, "direction").agg(F.count(F.lit(1)).alias("predictions_total"))


# Fixed values that must equal the reference's: latency histogram bucket bounds (seconds).
LATENCY_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5]


def latency_histogram(df: DataFrame, latency: str = "latency_seconds") -> DataFrame:
    """Cumulative ``le`` buckets (+Inf last) with the sum and count, as one row per bucket."""
    x = F.col(latency)
    aggs = [F.count_if(x <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(LATENCY_BUCKETS)]
    one = df.agg(*aggs, F.count(x).alias("binf"), F.sum(x).alias("latency_sum"), F.count(x).alias("latency_count"))
    labels = [repr(b) for b in LATENCY_BUCKETS] + ["+Inf"]
    cols = [f"b{i}" for i in range(len(LATENCY_BUCKETS))] + ["binf"]
    pairs = ", ".join(f"'{lab}', `{c}`" for lab, c in zip(labels, cols))
    return one.selectExpr(f"stack({len(cols)}, {pairs}) as (le, bucket_count)", "latency_sum", "latency_count")
