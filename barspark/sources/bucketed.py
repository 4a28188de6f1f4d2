"""Tables stored in hash buckets, so that a join on the bucket keys moves no row.

The buckets are by (ticker, date), the join's own keys: a hot ticker's bars spread over all buckets, and two tables with
the same number of buckets meet bucket by bucket, already sorted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from barspark.functions.features import FeatureSet
from barspark.operators.labels import drop_unlabeled
from barspark.schemas import DATE, TICKER
from barspark.session import shuffle_partitions
from barspark.sources import fsutil

KEYS = [TICKER, DATE]


def write_bucketed(rows: DataFrame, name: str, path: str | None = None, buckets: int | None = None) -> str:
    """Store rows as ``buckets`` sorted buckets (one file each) of an external table; returns its catalog name.

    ``path`` is the table's folder (a fresh one under the shared checkpoint folder by default).
    """
    spark = rows.sparkSession
    n = buckets or shuffle_partitions(spark)
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = rows.repartition(n, *KEYS)  # the hash of the buckets: each task writes one of them
    writer = dealt.write.bucketBy(n, *KEYS).sortBy(*KEYS).option("path", path or fsutil.scratch(spark, name))
    writer.mode("error").saveAsTable(table)
    return table


def training_set_bucketed(spark: SparkSession, labels: str, features: str, fs: FeatureSet) -> DataFrame:
    """J1 of two bucketed tables: as :func:`barspark.operators.training.training_set`, without an exchange."""
    lab = drop_unlabeled(spark.table(labels).select(*KEYS, "label")).hint("merge")
    return lab.join(spark.table(features).select(*KEYS, *fs.feature_names), KEYS).dropna(how="any")
