"""Every registered query against its DuckDB oracle (the driver's check) on the smallest data,
and partition-count invariance for a representative subset."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from oracle_check import canon, duck

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# Two hundred trees a fit: run by oracle_check.py; test_jobs_entry.py covers the jobs with few trees.
MODEL_JOBS = {"gbt_metrics", "batch_predictions", "baseline_run", "engineered_run", "champion_scoring"}


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n not in MODEL_JOBS and not n.startswith("op")))
def test_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canon(got) == canon(want)


@pytest.mark.parametrize(
    "name", ["features_v2", "forward_labels", "prediction_status", "roc_auc_by_ticker", "promotion_history", "training_stats"]
)
def test_partition_count_invariance(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(canon(QUERIES[name](spark, SF).toPandas()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
