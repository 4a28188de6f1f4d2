"""Scoring: requests against latest bars (J5), batch scoring with drift and log, and scoring on streams (ST4), each
micro-batch by the champion that is pinned to it (ST5)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.functions.columns import direction
from barspark.functions.features import ENGINEERED_V2, FeatureSet
from barspark.operators import drift as drift_op
from barspark.plans import training_jobs as jobs
from barspark.schemas import DATE, TICKER
from barspark.sources import fsutil, predlog
from barspark.sources.store import latest_features, load_training_stats
from barspark.streaming.features import stream_features


def request_status(requests: DataFrame, bars: DataFrame) -> DataFrame:
    """Each requested ticker with its latest bar time, or ``unknown_ticker`` (the 404 case)."""
    latest = bars.groupBy(TICKER).agg(F.max(DATE).alias("latest_bar"))
    joined = requests.select(TICKER).distinct().join(latest, TICKER, "left")
    return joined.select(
        TICKER,
        F.when(F.col("latest_bar").isNull(), F.lit("unknown_ticker")).otherwise(F.lit("ok")).alias("status"),
        F.date_format("latest_bar", "yyyy-MM-dd HH:mm:ss").alias("prediction_date"),
    )


def request_answers(requests: DataFrame, bars: DataFrame) -> DataFrame:
    """J5 for every single request: its own columns, then ``status`` and ``latest_bar`` (as text) of its ticker.

    The bars are reduced to one row a requested ticker first, so the join is small on that side however many bars there are;
    a hot ticker's requests meet one row (skewed partitions of it are split by AQE).
    """
    state = request_status(requests, bars).withColumnRenamed("prediction_date", "latest_bar")
    own = [c for c in requests.columns if c not in ("status", "latest_bar")]
    return requests.select(*own).join(state, TICKER, "left")


def _request_names(columns: list[str], taken: list[str]) -> dict[str, str]:
    """Names of the requests' own columns in the result: ``request_`` before those the result has itself."""
    used = {c.lower() for c in [*columns, *taken]}
    out = {}
    for c in columns:
        name = c
        if c.lower() in {t.lower() for t in taken}:
            name = f"request_{c}"
            while name.lower() in used:
                name = f"request_{name}"
            used.add(name.lower())
        out[c] = name
    return out


def score_requests(
    requests: DataFrame,
    bars: DataFrame,
    model: PipelineModel,
    model_version: str,
    stats: DataFrame | None,
    fs: FeatureSet = ENGINEERED_V2,
) -> tuple[DataFrame, DataFrame]:
    """(responses, errors): every request row comes out once, with its own columns; those named like a
    column of the responses or errors (a logged ``prediction_date``, ``probability``) are called ``request_...``.

    A request whose ticker has no bars is ``unknown_ticker``; one with too few bars for a full vector is
    ``short_history``; all others are answered: online vector -> model -> drift.
    """
    answers = ["status", "prediction_date", *fs.feature_names, "direction", "probability", "model_version", "feature_set"]
    names = _request_names([c for c in requests.columns if c != TICKER], [*answers, "drifted_features", "drift_detected"])
    # scored under names that neither the vectors nor the model use
    own = {c: f"_request_{i}" for i, c in enumerate(names)}
    requests = requests.select(TICKER, *[F.col(f"`{c}`").alias(o) for c, o in own.items()])
    extra = [F.col(o).alias(names[c]) for c, o in own.items()]
    asked = requests.select(TICKER).distinct()
    known = bars.join(asked, TICKER, "left_semi")
    vectors = latest_features(known, fs)
    full = sum((F.col(n).isNull().cast("int") for n in fs.feature_names), F.lit(0)) == 0
    state = asked.join(vectors.withColumn("_full", full), TICKER, "left")
    state = state.withColumn(
        "status", F.when(F.col("_full").isNull(), "unknown_ticker").when(~F.col("_full"), "short_history").otherwise("ok")
    )
    joined = requests.join(state, TICKER, "left").withColumn("status", F.coalesce("status", F.lit("unknown_ticker")))
    errors = joined.where(F.col("status") != "ok").select(TICKER, *extra, "status")
    scored = jobs.predict(model, joined.where(F.col("status") == "ok"))
    out = scored.select(
        TICKER,
        *extra,
        "prediction_date",
        *fs.feature_names,
        direction(F.col("prediction") == 1).alias("direction"),
        F.col("probability"),
        F.lit(model_version).alias("model_version"),
        F.lit(fs.label).alias("feature_set"),
    )
    if stats is not None:
        out = out.withColumns(drift_op.drift_columns(fs.feature_names, drift_op.stats_dict(stats)))
    else:
        out = out.withColumn("drifted_features", F.array().cast("array<string>")).withColumn(
            "drift_detected", F.lit(False)
        )
    return out, errors


def pinned_version(spark: SparkSession, folder: str, epoch: int, resolve: Callable[[], str]) -> str:
    """ST5: the model version that an epoch is scored with, resolved once and kept as a record.

    A retried epoch reads the record, also when the champion has changed since; of two writers the first one's record stays.
    """
    path = fsutil.join(folder, f"epoch-{epoch:020d}")
    version = fsutil.read_text(spark, path)
    if version is None:
        try:
            fsutil.create_text(spark, path, resolve())
        except FileExistsError:
            pass
        version = fsutil.read_text(spark, path)
    return version


def champion_of(spark: SparkSession, root: str) -> tuple[Callable[[], str], Callable[[str], PipelineModel]]:
    """(the champion's version now, the model of a version) of the run log under ``root``."""

    def resolve() -> str:
        found = jobs.champion(spark, root)
        if found is None:
            raise RuntimeError(f"model {jobs.MODEL_NAME!r} has no champion yet")
        return str(found["champion_version"])

    return resolve, lambda version: jobs.load_version(spark, root, version)


def stored_stats(spark: SparkSession, root: str, fs: FeatureSet) -> DataFrame | None:
    try:
        return load_training_stats(spark, root, fs)
    except FileNotFoundError:
        return None


def serve_stream(requests_stream: DataFrame, bars_loader, root: str, log_path: str, checkpoint: str, fs=ENGINEERED_V2):
    """Requests that name a ticker, scored against a bar table: the champion pinned to the micro-batch, drift, log.

    ``bars_loader(spark)`` returns the bar table, which is read for the tickers asked for; :func:`score_stream` scores
    from the stream's own state instead.  Each epoch writes its own folder of the log, and its refused requests one beside it
    (``<log>_errors``); a retried epoch writes the same folders again, so nothing is logged twice."""
    resolve, load = champion_of(requests_stream.sparkSession, root)

    def each(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        version = pinned_version(spark, f"{log_path.rstrip('/')}_versions", epoch_id, resolve)
        out, errors = score_requests(batch, bars_loader(spark), load(version), version, stored_stats(spark, root, fs), fs)
        predlog.append_predictions(out, log_path, epoch=epoch_id)
        errors.write.mode("overwrite").json(fsutil.join(f"{log_path.rstrip('/')}_errors", f"epoch={epoch_id}"))

    q = requests_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()
    q.awaitTermination()
    return q


SCORED = ["status", "direction", "probability", "model_version", "drifted_features", "drift_detected"]


def score_stream(
    bars_stream: DataFrame,
    scores_path: str,
    log_path: str,
    state_root: str,
    checkpoint: str,
    resolve: Callable[[], str],
    load: Callable[[str], PipelineModel],
    stats: DataFrame | None,
    fs: FeatureSet = ENGINEERED_V2,
):
    """ST4: every new bar scored from the stream's own state (ST3): vector -> pinned model -> drift -> log.

    Bars are read once, as they arrive.  An epoch's folder of ``scores_path`` holds each of its new bars with its
    features and ``SCORED``; bars in the warm-up are ``short_history``, the others are appended to the prediction log.
    ``resolve()`` names the version in force, ``load(version)`` gives its model.  Retried epochs write the same
    folders with the same version.  The feature table itself is written beside the scores (``<scores>_features``).
    """
    inlined = None if stats is None else drift_op.stats_dict(stats)

    def each(feats: DataFrame, epoch: int) -> None:
        spark = feats.sparkSession
        version = pinned_version(spark, fsutil.join(state_root, "versions"), epoch, resolve)
        full = sum((F.col(n).isNull().cast("int") for n in fs.feature_names), F.lit(0)) == 0
        scored = jobs.predict(load(version), feats.where(full)).withColumns(
            {"status": F.lit("ok"), "direction": direction(F.col("prediction") == 1), "model_version": F.lit(version)}
        )
        drift = drift_op.drift_columns(fs.feature_names, inlined or {})
        scored = scored.withColumns(drift).select(*feats.columns, *SCORED)
        refused = feats.where(~full).withColumn("status", F.lit("short_history"))
        path = fsutil.join(scores_path, f"epoch={epoch}")
        scored.unionByName(refused, allowMissingColumns=True).write.mode("overwrite").parquet(path)
        answered = spark.read.parquet(path).where("status = 'ok'")
        dated = answered.withColumn("prediction_date", F.date_format(DATE, "yyyy-MM-dd HH:mm:ss"))
        predlog.append_predictions(dated, log_path, epoch=epoch)

    return stream_features(bars_stream, fs, f"{scores_path.rstrip('/')}_features", state_root, checkpoint, on_features=each)
