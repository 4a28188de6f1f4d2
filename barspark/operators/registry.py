"""Model registry as an append-only ``runs`` table.

Versions, promotions and the champion alias are *derived* from the run history instead of
being kept in a mutable store: version = position of a (non-dry) run within its model; the
champion/challenger rule is an ordered fold per model.  A run history holds one row per training
job, so the per-model fold works on a small group whose size is the number of training runs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed value that must equal the reference's.
PROMOTION_THRESHOLD = 0.005


def run_versions(runs: DataFrame) -> DataFrame:
    """Every non-dry run of a model gets the next version number, promoted or not."""
    w = Window.partitionBy("model").orderBy("run_seq", "run_id")
    return runs.where(~F.col("dry_run")).withColumn("version", F.row_number().over(w))


def promotion_history(runs: DataFrame, threshold: float = PROMOTION_THRESHOLD) -> DataFrame:
    """C5 over the whole history: for each run, was it promoted, and who is champion after it.

    Rule per run: no champion yet -> promote; otherwise promote iff
    ``challenger_auc - champion_auc >= threshold`` (a missing AUC counts as 0.0; a NaN never
    wins, and a NaN champion is never beaten; ``nan_champion`` flags that state).
    """
    versioned = run_versions(runs).select("model", "run_seq", "run_id", "version", "roc_auc")
    ordered = versioned.repartition("model").sortWithinPartitions("model", "run_seq", "run_id")
    schema = (
        "model string, run_seq bigint, run_id string, version int, roc_auc double, promoted boolean, "
        "champion_version int, champion_auc double, nan_champion boolean"
    )

    def fold(batches):
        # one pass over the sorted runs; a model's state is its champion
        model, champion = None, None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row.model != model:
                    model, champion = row.model, None
                auc = 0.0 if row.missing else row.roc_auc
                promoted = champion is None or auc - champion[1] >= threshold  # false for a NaN on either side
                champion = (row.version, auc) if promoted else champion
                out.append((row.model, row.run_seq, row.run_id, row.version, auc, promoted, *champion, champion[1] != champion[1]))
            yield pd.DataFrame(out, columns=names)

    names = [c.split()[0] for c in schema.split(", ")]
    # pandas has one notion of missing: a null AUC is told apart from NaN before it gets there
    marked = ordered.withColumn("missing", F.col("roc_auc").isNull())
    return marked.mapInPandas(fold, schema)


def alias_history(history: DataFrame) -> DataFrame:
    """Each promotion moves the alias; valid from its run until the next promotion."""
    w = Window.partitionBy("model").orderBy("run_seq")
    promoted = history.where(F.col("promoted"))
    return promoted.select(
        "model",
        "version",
        "run_id",
        F.col("run_seq").alias("valid_from_seq"),
        F.lead("run_seq").over(w).alias("valid_to_seq"),
    )


def current_champion(history: DataFrame) -> DataFrame:
    """The version the alias points at after the last run of each model."""
    promoted = history.where(F.col("promoted"))
    return promoted.groupBy("model").agg(
        F.max_by("version", "run_seq").alias("champion_version"),
        F.max_by("run_id", "run_seq").alias("champion_run_id"),
    )


def champion_metrics(history: DataFrame, runs: DataFrame) -> DataFrame:
    """Champion version -> its run's metrics (one row per model; small, joined on run_id)."""
    champ = current_champion(history)
    return champ.join(
        runs.select(F.col("run_id").alias("champion_run_id"), "roc_auc"), "champion_run_id", "inner"
    ).select("model", "champion_version", "champion_run_id", "roc_auc")


def decide(challenger_auc: float | None, champion_auc: float | None, threshold: float = PROMOTION_THRESHOLD) -> bool:
    """Single decision (driver-side scalar), the same rule as the fold."""
    if champion_auc is None:
        return True
    challenger = 0.0 if challenger_auc is None else challenger_auc
    return (challenger - champion_auc) >= threshold
