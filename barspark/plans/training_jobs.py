"""Training jobs (M1-M6) and the run log (C4, C6), on MLlib and plain tables.

The classifier is MLlib's gradient-boosted trees with the reference's hyper-parameters (not
bit-equal to XGBoost).  Runs are numbered records of a ``runs`` folder, each created only if its number is free, so
parallel jobs get numbers of their own; versions, promotions and the champion are derived from them
(:mod:`barspark.operators.registry`).
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.functions.features import BASELINE_COLUMNS, ENGINEERED_V2, FeatureSet
from barspark.operators import labels as labels_op
from barspark.operators import metrics as metrics_op
from barspark.operators import registry as reg_op
from barspark.operators import training as train_op
from barspark.operators.validate import validate
from barspark.schemas import DATE, RUNS, TICKER
from barspark.session import materialize
from barspark.sources import fsutil, store

# Fixed values that must equal the reference's (classifier hyper-parameters).
GBT_PARAMS = {
    "n_estimators": 200,
    "max_depth": 4,
    "learning_rate": 0.05,
    "subsample": 0.8,
    "colsample_bytree": 0.8,
    "random_state": 42,
}
MODEL_NAME = "direction_classifier"
# Baseline runs are logged for comparison but never compete for the champion alias.
BASELINE_MODEL_NAME = "baseline_classifier"


def gbt(params: dict | None = None) -> GBTClassifier:
    p = {**GBT_PARAMS, **(params or {})}
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=int(p["n_estimators"]),
        maxDepth=int(p["max_depth"]),
        stepSize=float(p["learning_rate"]),
        subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy=str(p["colsample_bytree"]),
        seed=int(p["random_state"]),
    )


def fit(train: DataFrame, feature_cols: list[str], params: dict | None = None) -> PipelineModel:
    """M1: assemble the features in set order and fit; the test set plays no part in fitting."""
    assembler = VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error")
    data = train.withColumn("label", F.col("label").cast("double"))
    return Pipeline(stages=[assembler, gbt(params)]).fit(data)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M2: class and P(UP) per row, vectorised inside MLlib (no Python UDF)."""
    out = model.transform(df)
    return out.withColumn("prediction", F.col("prediction").cast("int")).withColumn(
        "probability", vector_to_array("probability")[1]
    ).drop("features", "rawPrediction")


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Metrics of the scored test set, which is written once (the metrics read it several times)."""
    scored = materialize(predict(model, test).select("label", "prediction", "probability"), "scored")
    return metrics_op.classification_metrics(scored, "label", "prediction", "probability")


@dataclass
class RunResult:
    run_id: str
    metrics: dict
    params: dict = field(default_factory=dict)
    model_path: str | None = None


def metrics_dict(metrics: DataFrame) -> dict:
    row = metrics.collect()[0]  # one row by construction
    return {k: float(row[k]) for k in row.asDict()}


def runs_table(root: str) -> str:
    return fsutil.join(root, "runs")


_RECORD = re.compile(r"run-(\d+)\.json")


def _run_numbers(spark: SparkSession, root: str) -> list[int]:
    found = (_RECORD.fullmatch(n) for n in fsutil.list_names(spark, runs_table(root)))
    return sorted(int(m[1]) for m in found if m)


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    if not _run_numbers(spark, root):
        return spark.createDataFrame([], RUNS)
    return spark.read.schema(RUNS).json(runs_table(root))


def record_run(spark: SparkSession, root: str, result: RunResult, model: str = MODEL_NAME, dry_run: bool = False) -> int:
    """One run (params, metrics, model path) under the next free number, which is returned.

    A record is created only if no other has its number; a writer that comes second takes the next one.
    """
    row = {
        "run_id": result.run_id,
        "model": model,
        "roc_auc": result.metrics.get("roc_auc"),
        "dry_run": bool(dry_run),
        "model_path": result.model_path,
        "params": {k: str(v) for k, v in result.params.items()},
        "metrics": {k: float(v) for k, v in result.metrics.items()},
    }
    seq = max(_run_numbers(spark, root), default=0) + 1
    while True:
        try:
            fsutil.create_text(spark, fsutil.join(runs_table(root), f"run-{seq:09d}.json"), json.dumps(row | {"run_seq": seq}))
            return seq
        except FileExistsError:
            seq += 1


#: Tickers named in a run's parameters; of more of them the first by name and the count are.
LOGGED_TICKERS = 1000


def ticker_names(bars: DataFrame) -> str:
    """The tickers of a run, by name, joined by commas."""
    names = [r[0] for r in bars.select(TICKER).distinct().orderBy(TICKER).limit(LOGGED_TICKERS + 1).collect()]
    if len(names) <= LOGGED_TICKERS:
        return ",".join(map(str, names))
    return ",".join(map(str, names[:LOGGED_TICKERS])) + f",... ({bars.select(TICKER).distinct().count()} in all)"


def _save(model: PipelineModel, root: str, run_id: str) -> str:
    path = fsutil.join(root, "models", run_id)
    model.write().overwrite().save(path)
    return path


def run_baseline(spark: SparkSession, bars: DataFrame, root: str, split_date: str = labels_op.BASELINE_SPLIT_DATE,
                 params: dict | None = None, record: bool = True) -> RunResult:
    """M4: validate -> labelled OHLCV -> time split -> fit -> metrics -> run log."""
    with fsutil.scratch_scope(spark):
        return _run_baseline(spark, bars, root, split_date, params, record)


def _run_baseline(spark, bars, root, split_date, params, record) -> RunResult:
    validate(bars)
    data = materialize(train_op.baseline_dataset(bars), "training")
    train, test = labels_op.time_split(data, split_date)
    model = fit(train, BASELINE_COLUMNS, params)
    m = metrics_dict(evaluate(model, test))
    counts = train_op.split_counts(data, split_date, keys=[]).collect()[0]  # one row
    run_id = uuid.uuid4().hex
    logged = {
        **GBT_PARAMS, **(params or {}), "test_split_date": split_date, "feature_columns": ",".join(BASELINE_COLUMNS),
        "tickers": ticker_names(bars), "train_rows": counts["train_rows"], "test_rows": counts["test_rows"],
    }
    res = RunResult(run_id, m, logged, _save(model, root, run_id))
    if record:
        record_run(spark, root, res, model=BASELINE_MODEL_NAME)
    return res


def run_engineered(spark: SparkSession, bars: DataFrame, root: str, split_date: str, run_date: str | None = None,
                   fs: FeatureSet = ENGINEERED_V2, params: dict | None = None, record: bool = True,
                   features: DataFrame | None = None) -> RunResult:
    """M5: validate -> labels ⋈ features -> split -> training stats (saved) -> fit -> metrics -> fingerprint.

    ``features`` is the stored feature table (J1 join with the labels, as the reference does);
    without it, features and labels come from one window pass over the bars (no join).
    The reference validates only on the baseline path; raw bars are validated here as well.
    Lineage-cut tables the run creates are removed when it has finished.
    """
    with fsutil.scratch_scope(spark):
        return _run_engineered(spark, bars, root, split_date, run_date, fs, params, record, features)


def _run_engineered(spark, bars, root, split_date, run_date, fs, params, record, features) -> RunResult:
    validate(bars)
    if features is not None:
        data = train_op.training_set(labels_op.add_labels(bars), features, fs)
    else:
        data = train_op.training_frame(bars, fs)
    data = materialize(data, "training")  # stats, fit, counts, fingerprint and scoring read this table
    train, test = labels_op.time_split(data, split_date)
    stats = train_op.training_stats(train, fs.feature_names)
    stats_path = store.save_training_stats(stats, root, fs)
    model = fit(train, fs.feature_names, params)
    m = metrics_dict(evaluate(model, test))
    fp = train_op.fingerprint(train, [TICKER, DATE, "label", *fs.feature_names], fs.feature_names, [DATE]).collect()[0]
    counts = train_op.split_counts(data, split_date, keys=[]).collect()[0]
    run_id = uuid.uuid4().hex
    params_out = {
        **GBT_PARAMS, **(params or {}), "test_split_date": split_date, "feature_set": fs.name,
        "feature_set_version": fs.version, "feature_columns": ",".join(fs.feature_names),
        "train_rows": counts["train_rows"], "test_rows": counts["test_rows"],
        "train_data_fingerprint": f"{fp['digest']}:{fp['rows']}", "training_stats_path": stats_path,
        "tickers": ticker_names(bars),
    }
    if run_date is not None:
        params_out["run_date"] = run_date
    res = RunResult(run_id, m, params_out, _save(model, root, run_id))
    if record:
        record_run(spark, root, res)
    return res


def champion(spark: SparkSession, root: str) -> dict | None:
    """C3 + J7 for the model: version, run id, model path, AUC of the current champion."""
    runs = read_runs(spark, root)
    hist = reg_op.promotion_history(runs.where(F.col("model") == MODEL_NAME))
    champ = reg_op.current_champion(hist).join(
        runs.select(F.col("run_id").alias("champion_run_id"), "model_path", "roc_auc"), "champion_run_id"
    ).collect()
    return champ[0].asDict() if champ else None


def load_champion(spark: SparkSession, root: str) -> tuple[PipelineModel, str]:
    """C4: the champion's model; ``RuntimeError`` when there is none."""
    c = champion(spark, root)
    if c is None:
        raise RuntimeError(f"model {MODEL_NAME!r} has no champion yet")
    return PipelineModel.load(c["model_path"]), str(c["champion_version"])


def load_version(spark: SparkSession, root: str, version: str) -> PipelineModel:
    """The model of a registered version, promoted or not; ``RuntimeError`` when there is none."""
    runs = read_runs(spark, root).where(F.col("model") == MODEL_NAME)
    found = reg_op.run_versions(runs).where(F.col("version") == int(version)).select("model_path").collect()  # one row
    if not found:
        raise RuntimeError(f"model {MODEL_NAME!r} has no version {version}")
    return PipelineModel.load(found[0][0])


def run_dated(spark: SparkSession, bars: DataFrame, root: str, run_date: str, dry_run: bool = False,
              params: dict | None = None) -> tuple[RunResult, bool]:
    """M6: split = run_date - 90 days; train; decide promotion (C5) against the champion.

    Dry runs train and evaluate but write nothing to the run log.
    """
    split = labels_op.compute_split_date(spark, run_date)
    res = run_engineered(spark, bars, root, split, run_date, params=params, record=False)
    c = champion(spark, root)
    promoted = reg_op.decide(res.metrics.get("roc_auc"), None if c is None else (c["roc_auc"] or 0.0))
    if not dry_run:
        record_run(spark, root, res)
    return res, promoted


def main(argv: list[str] | None = None) -> None:  # pragma: no cover - spark-submit entry
    import argparse
    import datetime as dt

    from barspark.session import build_session
    from barspark.sources.bars import read_bars

    ap = argparse.ArgumentParser(description="Dated training run: fit, evaluate, record, decide on the champion.")
    ap.add_argument("--bars", required=True)
    ap.add_argument("--root", required=True)
    ap.add_argument("--run-date", default=None)
    ap.add_argument("--dry-run", action="store_true")
    a = ap.parse_args(argv)
    spark = build_session()
    run_date = a.run_date or dt.date.today().isoformat()
    res, promoted = run_dated(spark, read_bars(spark, a.bars), a.root, run_date, a.dry_run)
    print({"run_id": res.run_id, "roc_auc": res.metrics.get("roc_auc"), "promoted": promoted, "dry_run": a.dry_run})


if __name__ == "__main__":  # pragma: no cover
    main()
