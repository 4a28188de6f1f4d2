"""Feature build job (E2): bar table -> validate -> features -> partitioned feature table.

One plan for all tickers (no per-ticker loop): scan -> one exchange -> windows -> write.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from barspark.functions.features import ENGINEERED_V2, FeatureSet
from barspark.operators.features import compute_features
from barspark.operators.validate import validate
from barspark.schemas import TICKER
from barspark.sources import fsutil, store
from barspark.sources.bars import read_bars


def build_offline(
    spark: SparkSession, bars_path: str, root: str, fs: FeatureSet = ENGINEERED_V2, tickers: list[str] | None = None
) -> str:
    """S5 + W11: compute every feature of ``fs`` for the given tickers (all by default) and write."""
    with fsutil.scratch_scope(spark):
        bars = read_bars(spark, bars_path)
        if tickers is not None:
            bars = bars.where(F.col(TICKER).isin(tickers))
        validate(bars)
        return store.write_features(compute_features(bars, fs), root, fs)


def main(argv: list[str] | None = None) -> None:  # pragma: no cover - spark-submit entry
    import argparse

    from barspark.functions.features import feature_set
    from barspark.session import build_session

    ap = argparse.ArgumentParser(description="Build or backfill the offline feature table.")
    ap.add_argument("--bars", required=True)
    ap.add_argument("--root", required=True)
    ap.add_argument("--version", type=int, default=2)
    ap.add_argument("--start", default=None)
    ap.add_argument("--end", default=None)
    ap.add_argument("--backfill", action="store_true")
    a = ap.parse_args(argv)
    spark = build_session()
    fs = feature_set("engineered", a.version)
    if a.backfill:
        print(store.backfill(spark, read_bars(spark, a.bars), fs, a.root, a.start, a.end))
    else:
        print(build_offline(spark, a.bars, a.root, fs))


if __name__ == "__main__":  # pragma: no cover
    main()
