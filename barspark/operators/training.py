"""Training data operators: label/feature join (J1), split counts (A3), training stats (A1),
dataset fingerprint (A9), baseline projection (P1) and the baseline dataset (M3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.functions.columns import epoch_micros
from barspark.functions.features import BASELINE_COLUMNS, FeatureSet
from barspark.operators.labels import add_labels, drop_unlabeled, time_split_column
from barspark.schemas import DATE, TICKER


def baseline_features(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys + ``open high low close volume`` in that order; a missing column is an error."""
    missing = set(BASELINE_COLUMNS) - set(df.columns)
    if missing:
        raise ValueError(f"the bars lack the columns {sorted(missing)}")
    keys = [k for k in (keys if keys is not None else [TICKER, DATE]) if k in df.columns]
    return df.select(*keys, *BASELINE_COLUMNS)


def baseline_dataset(bars: DataFrame, forward: int = 5, chunk_rows: int | None = None) -> DataFrame:
    """Load -> label -> project ``ticker, date, label, OHLCV`` -> drop unlabelled (M3)."""
    labelled = add_labels(bars, forward, chunk_rows=chunk_rows)
    return drop_unlabeled(labelled.select(TICKER, DATE, "label", *BASELINE_COLUMNS))


def training_set(labels: DataFrame, features: DataFrame, fs: FeatureSet) -> DataFrame:
    """Inner equi-join on (ticker, date) of labelled rows and the feature table, then drop nulls.

    Both sides come out of a (ticker, chunk) partitioning, so the join is a sort-merge join on
    (ticker, date): the hot ticker is spread over many dates, no single task owns it.
    """
    lab = drop_unlabeled(labels.select(TICKER, DATE, "label"))
    joined = lab.join(features.select(TICKER, DATE, *fs.feature_names), [TICKER, DATE], "inner")
    return joined.dropna(how="any")


def training_frame(bars: DataFrame, fs: FeatureSet, forward: int = 5, chunk_rows: int | None = None) -> DataFrame:
    """J1 without a join when both sides come from the same bars: features and the forward label
    in one window pass (look-back halo for the features, ``forward`` rows of look-ahead for the
    label), then the same null filtering as :func:`training_set`."""
    from barspark.operators.features import compute_features
    from barspark.operators.labels import forward_label

    label = {"label": lambda w: forward_label(F.col("close"), F.lead("close", forward).over(w))}
    rows = compute_features(bars, fs, extra=label, fwd=forward, chunk_rows=chunk_rows)
    return drop_unlabeled(rows).select(TICKER, DATE, "label", *fs.feature_names)


def split_counts(df: DataFrame, split_date: str, keys: list[str] | None = None) -> DataFrame:
    keys = keys if keys is not None else [TICKER]
    part = time_split_column(split_date)
    return df.groupBy(*keys).agg(
        F.count_if(part == "train").alias("train_rows"),
        F.count_if(part == "test").alias("test_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def training_stats(train: DataFrame, feature_names: list[str]) -> DataFrame:
    """``feature, mean, std`` (sample std, ddof 1) per feature in one aggregate pass.

    Columns not present are ignored, as in the reference.  The aggregate is a single row of
    2 x features values; ``stack`` turns it into one row per feature.
    """
    present = [f for f in feature_names if f in train.columns]
    aggs = []
    for name in present:
        aggs += [F.avg(name).alias(f"m_{name}"), F.stddev_samp(name).alias(f"s_{name}")]
    one = train.agg(*aggs)
    pairs = ", ".join(f"'{n}', `m_{n}`, `s_{n}`" for n in present)
    return one.selectExpr(f"stack({len(present)}, {pairs}) as (feature, mean, std)")


def _scaled(c: str, places: int = 6):
    return F.round(F.col(c) * F.lit(10.0**places)).cast("long").cast("string")


def row_text(columns: list[str], double_columns: list[str], time_columns: list[str]) -> Column:
    """A row as engine-neutral text: doubles as integers at 1e-6, wall-clock timestamps as epoch micros (time-zone
    free), everything else as text, nulls as nothing."""
    parts = []
    for c in columns:
        if c in double_columns:
            parts.append(F.coalesce(_scaled(c), F.lit("")))
        elif c in time_columns:
            parts.append(F.coalesce(epoch_micros(F.col(c)).cast("string"), F.lit("")))
        else:
            parts.append(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return F.concat_ws("|", *parts)


def _digest(df: DataFrame, text: Column) -> DataFrame:
    """Sum of the texts' md5 prefixes (as decimal) and the row count: combinable over any partitioning."""
    h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.sum(h).cast("string").alias("digest"), F.count(F.lit(1)).alias("rows"))


def fingerprint(df: DataFrame, columns: list[str], double_columns: list[str], time_columns: list[str]) -> DataFrame:
    """Order-free multiset digest of the rows (:func:`row_text`) plus the row count.  Same rows under any partitioning -> same digest."""
    return _digest(df, row_text(columns, double_columns, time_columns))


def ordered_fingerprint(
    df: DataFrame, order: list[str], columns: list[str], double_columns: list[str], time_columns: list[str]
) -> DataFrame:
    """A9 that depends on the order of the rows: ``digest, rows`` as :func:`fingerprint`, each row's text behind its
    global position in ``order``.

    Rows that trade places change two of the hashed texts; changing the partitions changes none.  The positions
    come from one range sort (:func:`barspark.operators.sequence.sequence`), the digest from a partial aggregate.
    Rows equal in ``order`` are placed by their other columns.
    """
    from barspark.operators.sequence import SEQ, sequence

    total = [*order, *[c for c in columns if c not in order]]
    placed = sequence(df.select(*total), [], total).rows
    return _digest(placed, F.concat_ws("|", F.col(SEQ).cast("string"), row_text(columns, double_columns, time_columns)))
