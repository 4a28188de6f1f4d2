"""Offline feature table, latest/online vectors, training stats and backfill."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.functions.features import Feature, FeatureSet, with_helpers
from barspark.operators.features import compute_features
from barspark.schemas import DATE, TICKER, TRAINING_STATS
from barspark.session import materialize
from barspark.sources import fsutil
from barspark.sources.versions import VersionedTable


def store_dir(root: str, fs: FeatureSet) -> str:
    return fsutil.join(root, fs.label)


MONTH = "_month"


def feature_schema(fs: FeatureSet) -> T.StructType:
    values = [T.StructField(n, T.DoubleType()) for n in fs.feature_names]
    return T.StructType([T.StructField(TICKER, T.StringType()), T.StructField(DATE, T.TimestampNTZType()), *values])


def feature_table(spark: SparkSession, root: str, fs: FeatureSet) -> VersionedTable:
    """The one stored table of a feature set: full builds, backfills and readers share it."""
    return VersionedTable(spark, store_dir(root, fs))


def _with_month(rows: DataFrame, fs: FeatureSet) -> DataFrame:
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in feature_schema(fs).fields])
    return typed.withColumn(MONTH, F.date_format(DATE, "yyyy-MM"))


def _publish(rows: DataFrame, table: VersionedTable, months: list[str], everything: bool = False) -> str:
    """Rows range-partitioned by (month, ticker, date): few files a month, each a run of tickers."""
    laid = rows.repartitionByRange(MONTH, TICKER, DATE).sortWithinPartitions(MONTH, TICKER, DATE)
    table.replace(laid, MONTH, months, everything)
    return table.base


def write_features(features: DataFrame, root: str, fs: FeatureSet) -> str:
    """The written tickers' rows replace their stored ones; other tickers keep theirs."""
    table = feature_table(features.sparkSession, root, fs)
    new = materialize(_with_month(features, fs), "features")
    if not table.numbers():
        table.folders()  # refuses a table whose first write did not finish
        return _publish(new, table, [], everything=True)
    old = _with_month(table.read(feature_schema(fs)), fs)
    kept = old.join(new.select(TICKER).distinct(), TICKER, "left_anti")
    return _publish(kept.unionByName(new), table, [], everything=True)


def read_features(spark: SparkSession, root: str, fs: FeatureSet, tickers: list[str] | None = None) -> DataFrame:
    """Scan the feature table, pruned to ``tickers``; a missing table or ticker is an error."""
    table = feature_table(spark, root, fs)
    if not table.folders():
        raise FileNotFoundError(f"{fs.label} has no stored table under {root}: build it first")
    df = table.read(feature_schema(fs))
    if tickers is not None:
        df = df.where(F.col(TICKER).isin(tickers))
        present = {r[TICKER] for r in df.select(TICKER).distinct().collect()}
        missing = [t for t in tickers if t not in present]
        if missing:
            raise FileNotFoundError(f"the {fs.label} table under {root} lacks ticker {missing[0]!r}")
    return df


def tail_n(bars: DataFrame, n: int, keys: list[str] | None = None, time: str = DATE) -> DataFrame:
    """Last ``n`` rows per ticker.  ``row_number <= n`` lets Spark run a partial window group
    limit before the shuffle, so at most ``n`` rows per ticker per map task move."""
    keys = keys or [TICKER]
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc())
    return bars.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest_features(
    bars: DataFrame,
    fs: FeatureSet,
    keys: list[str] | None = None,
    time: str = DATE,
    date_format: str = "yyyy-MM-dd HH:mm:ss",
) -> DataFrame:
    """W10 + T4: the online vector of every ticker, from its last ``max_required_window`` bars.

    Window features equal the offline ones at the last row; an EMA feature uses the online
    definition (MACD over the slice, seeded at the slice start).  A user feature without a Column form is
    called on each ticker's slice of ``lookback + 1`` bars, in the grouping that the windows use.  Short slices give nulls.
    ``prediction_date`` is the last bar's time as text: date and time by default (bars may be
    intraday); ``date_format="yyyy-MM-dd"`` gives the date-only form of daily bars.
    """
    keys = keys or [TICKER]
    called = [f for f in fs.features if f.online is None and f.build is None]
    n = max([fs.max_required_window, *[f.lookback + 1 for f in called]])
    tail = tail_n(bars, n, keys, time)
    # the slice holds at most n rows per ticker: a plain per-ticker window is bounded here
    w = Window.partitionBy(*keys).orderBy(time)
    rows = with_helpers(tail, w)
    cols = {f.name: f.online_column(w) for f in fs.features if f not in called}
    rows = rows.withColumns(cols).withColumn("_last", F.row_number().over(w.orderBy(F.col(time).desc())))
    if called:
        rows = _with_called(rows, keys, time, called)
    return rows.where(F.col("_last") == 1).select(
        *keys, F.date_format(time, date_format).alias("prediction_date"), *fs.feature_names
    )


def _with_called(rows: DataFrame, keys: list[str], time: str, features: list[Feature]) -> DataFrame:
    """Each ticker's last row with the features' online values (one grouped map over the bounded slices)."""

    def last(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time, kind="stable", ignore_index=True)
        return pdf.tail(1).assign(**{f.name: f.online_value(pdf) for f in features})

    fields = [T.StructField(f.name, T.DoubleType()) for f in features]
    out = rows.groupBy(*keys).applyInPandas(last, T.StructType([*rows.schema.fields, *fields]))
    return out.withColumns({f.name: F.nanvl(F.col(f.name), F.lit(None).cast("double")) for f in features})


def online_parity(bars: DataFrame, fs: FeatureSet, tolerance: float = 1e-9) -> DataFrame:
    """X1's check: ``ticker, feature, online, offline, same`` of every ticker's last bar.

    ``same``: both null, or apart by at most ``tolerance`` of the greater (features whose online definition differs, as the MACD over 100
    bars, are expected to be apart).
    """
    last = bars.groupBy(TICKER).agg(F.max(DATE).alias(DATE))
    offline = compute_features(bars, fs, dropna=False).join(last, [TICKER, DATE], "left_semi")
    online = latest_features(bars, fs)
    names = fs.feature_names

    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias(name)) for n in names]))
        return df.select(TICKER, pairs.alias("p")).select(TICKER, "p.feature", f"p.{name}")

    near = F.abs(F.col("online") - F.col("offline")) <= tolerance * F.greatest(F.abs("online"), F.abs("offline"), F.lit(1e-300))
    both = long(online, "online").join(long(offline, "offline"), [TICKER, "feature"])
    none = F.col("online").isNull() & F.col("offline").isNull()
    return both.withColumn("same", none | F.coalesce(near, F.lit(False)))


def backfill_slice(bars: DataFrame, fs: FeatureSet, start: str | None, end: str | None) -> DataFrame:
    """Features recomputed on the full history, then ``start <= date <= end`` (both optional).

    The date filter must stay above the windows (it is applied to the feature output, never to
    the bars), else look-backs near ``start`` would lose their history.
    """
    feats = compute_features(bars, fs)
    if start is not None:
        feats = feats.where(F.col(DATE) >= F.to_timestamp_ntz(F.lit(start)))
    if end is not None:
        feats = feats.where(F.col(DATE) <= F.to_timestamp_ntz(F.lit(end)))
    return feats


def require_rows_per_ticker(new: DataFrame, tickers: DataFrame, start, end) -> None:
    """Raise ``ValueError`` when some requested ticker has no rows in the slice."""
    missing = tickers.join(new.select(TICKER).distinct(), TICKER, "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"the range {start} .. {end} leaves ticker {missing[0][TICKER]!r} without feature rows")


def upsert(existing: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """U2 merge: rows of ``new`` replace rows of ``existing`` with the same (ticker, date).

    Duplicates inside ``existing`` collapse as well (the last written wins, by ``_load_seq``
    when present).  Rows outside the new slice are kept, including in-range stale rows that the
    new computation no longer produces (reference behaviour).
    """
    keys = keys or [TICKER, DATE]
    cols = new.columns
    kept = existing.select(*cols).join(new.select(*keys), keys, "left_anti")
    if "_load_seq" in existing.columns:
        w = Window.partitionBy(*keys).orderBy(F.col("_load_seq").desc())
        kept = (
            existing.join(new.select(*keys), keys, "left_anti")
            .withColumn("_r", F.row_number().over(w))
            .where(F.col("_r") == 1)
            .select(*cols)
        )
    return kept.unionByName(new)


def backfill(
    spark: SparkSession, bars: DataFrame, fs: FeatureSet, root: str, start: str | None, end: str | None
) -> str:
    """U2 end to end: compute the slice and merge it into the stored table (the one ``write_features`` fills).

    Only the months that the slice touches are read and written again; all other rows stay where
    they are.  Single-writer: one change per table at a time.  Returns the table's folder.
    """
    with fsutil.scratch_scope(spark):
        new = materialize(_with_month(backfill_slice(bars, fs, start, end), fs), "backfill")
        require_rows_per_ticker(new, bars.select(TICKER).distinct(), start, end)
        table = feature_table(spark, root, fs)
        months = sorted(r[0] for r in new.select(MONTH).distinct().collect())  # calendar months
        old = _with_month(table.read(feature_schema(fs), months) if table.folders() else table.read(feature_schema(fs), []), fs)
        return _publish(upsert(old, new), table, months)


def save_training_stats(stats: DataFrame, root: str, fs: FeatureSet) -> str:
    """``feature, mean, std`` as JSON next to the feature table (small: one row per feature)."""
    path = fsutil.join(store_dir(root, fs), "training_stats")
    stats.coalesce(1).write.mode("overwrite").json(path)
    return path


def load_training_stats(spark: SparkSession, root: str, fs: FeatureSet) -> DataFrame:
    """The saved stats; ``FileNotFoundError`` when none were saved."""
    path = fsutil.join(store_dir(root, fs), "training_stats")
    if not fsutil.exists(spark, path):
        raise FileNotFoundError(f"{fs.label} has no saved training stats under {root}")
    return spark.read.schema(TRAINING_STATS).json(path)
