"""Classification metrics (A4-A7): accuracy, exact ROC AUC with ties, precision/recall/F1, balance.

ROC AUC = sum over distinct scores of pos_s * (neg_below_s + neg_s / 2) / (P * N).  The running
``neg_below`` is a prefix sum over scores in order; it is computed with the chunked sequence
operator, so there is no unpartitioned window over the data, even when every score is distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.operators.sequence import core_only, frame, prefix_sum


def _per_score(df: DataFrame, label: str, score: str, prediction: str | None, keys: list[str]) -> DataFrame:
    """Sums by (keys, score) that every metric needs, with the negatives up to each score."""
    y = F.col(label)
    sums = {"_pos": y.cast("long"), "_neg": (1 - y).cast("long")}
    if prediction is not None:
        p = F.col(prediction)
        sums |= {"_ok": (y == p).cast("long"), "_tp": ((y == 1) & (p == 1)).cast("long"), "_fp": ((y == 0) & (p == 1)).cast("long")}
    per_score = df.groupBy(*keys, score).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    rows = frame(per_score, keys, [score])
    return core_only(prefix_sum(rows, keys, F.col("_neg"), "_neg_upto", [score]))


def _auc_sums() -> list:
    below = F.col("_neg_upto") - F.col("_neg")
    return [
        F.sum(F.col("_pos") * (below.cast("double") + F.col("_neg") / F.lit(2.0))).alias("_num"),
        F.sum("_pos").alias("_p"),
        F.sum("_neg").alias("_n"),
    ]


def _auc():
    both = (F.col("_p") > 0) & (F.col("_n") > 0)
    return F.when(both, F.col("_num") / (F.col("_p") * F.col("_n"))).otherwise(F.lit(float("nan"))).alias("roc_auc")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", keys: list[str] | None = None) -> DataFrame:
    """Exact AUC per group (``keys``; empty = overall).  NaN when a group has one class only."""
    keys = list(keys or [])
    return _per_score(df, label, score, None, keys).groupBy(*keys).agg(*_auc_sums()).select(*keys, _auc())


def _ratio(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score", keys=None
) -> DataFrame:
    """accuracy, roc_auc, precision/recall/F1 of class 1 (0 when undefined), label balance.

    One pass: the confusion counts are summed by score beside the AUC's, then once more per group.
    """
    keys = list(keys or [])
    cum = _per_score(df, label, score, prediction, keys)
    total = cum.groupBy(*keys).agg(*_auc_sums(), F.sum("_ok").alias("_hits"), F.sum("_tp").alias("_tps"), F.sum("_fp").alias("_fps"))
    n, tp, fp, fn = F.col("_p") + F.col("_n"), F.col("_tps"), F.col("_fps"), F.col("_p") - F.col("_tps")
    return total.select(
        *keys,
        _ratio(F.col("_hits"), n).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision_class1"),
        _ratio(tp, tp + fn).alias("recall_class1"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_class1"),
        F.try_divide(F.col("_p").cast("double"), n.cast("double")).alias("label_balance"),
        _auc(),
    )
