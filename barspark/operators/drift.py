"""3-sigma drift flags (D1) and the drift counter.

The stats table has one row per feature of a set, so its size is fixed by the feature set
definition (not by data): it is read once and inlined as literals, which keeps the check a
pure projection with no join or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.functions.columns import is_finite

# Fixed value that must equal the reference's.
N_SIGMA = 3.0


def stats_dict(stats: DataFrame, max_rows: int = 10_000) -> dict[str, tuple[float | None, float | None]]:
    rows = stats.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError("training stats must have one row per feature")
    return {r["feature"]: (r["mean"], r["std"]) for r in rows}


def drift_columns(
    feature_names: list[str], stats: dict[str, tuple[float | None, float | None]], n_sigma: float = N_SIGMA
) -> dict[str, Column]:
    """``drifted_features`` (array in feature order) and ``drift_detected``.

    A feature is skipped when it is unknown to the stats or its std is 0/NaN/null; it is flagged
    when ``|v - mean| / std > n_sigma`` (strict) and the z-score is a number.
    """
    flags = []
    for name in feature_names:
        if name not in stats:
            continue
        mean, std = stats[name]
        if mean is None or std is None or std != std or std == 0:
            continue
        z = F.abs(F.col(name) - F.lit(mean)) / F.lit(std)
        flags.append(F.when(is_finite(F.col(name)) & ~F.isnan(z) & (z > F.lit(n_sigma)), F.lit(name)))
    arr = F.filter(F.array(*flags), lambda x: x.isNotNull()) if flags else F.array().cast("array<string>")
    return {"drifted_features": arr, "drift_detected": F.size(arr) > 0}


def drift_flags(features: DataFrame, feature_names: list[str], stats: DataFrame, n_sigma: float = N_SIGMA) -> DataFrame:
    return features.withColumns(drift_columns(feature_names, stats_dict(stats), n_sigma))


def drift_events_total(flags: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["ticker"]
    return flags.where(F.col("drift_detected")).groupBy(*keys).agg(F.count(F.lit(1)).alias("drift_events_total"))
