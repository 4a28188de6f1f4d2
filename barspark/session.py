"""Session helpers: building a session for tests/bench and finding the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None, shuffle_partitions: int = 8, app: str = "barspark", event_log_dir: str | None = None
) -> SparkSession:
    """A session with the settings every job here assumes (UTC, AQE, no UI).

    ``event_log_dir`` turns on Spark's event log there (stage and task times without a UI).
    """
    builder = (
        SparkSession.builder.master(master or os.environ.get("BARSPARK_MASTER", "local[8]"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BARSPARK_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:
        builder = (
            builder.config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", event_log_dir)
            .config("spark.eventLog.compress", "false")
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local master may do without (tests): it gets a
    scratch folder.  On a cluster an unset folder is an error, as executors share no local one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="barspark-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Cut lineage by writing a Parquet table in the shared checkpoint folder and reading it back.

    Used where a plan is read by two branches that must see identical rows (ids that depend on
    partition layout) and where recomputation after an executor loss must not change them.  A
    columnar table is cheaper to write and re-read than an RDD checkpoint of serialized rows.
    """
    from barspark.sources import fsutil

    spark = df.sparkSession
    path = fsutil.scratch(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
