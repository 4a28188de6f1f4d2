from __future__ import annotations

import pandas as pd
from conftest import seasonal_bars, to_bars
from pyspark.sql import Window
from pyspark.sql import functions as F

from barspark.operators import sequence as Q


def test_dense_positions_match_row_number(spark):
    pdf = pd.concat([seasonal_bars(n, t, seed=i) for i, (t, n) in enumerate([("A", 300), ("B", 7), ("C", 90)])])
    bars = to_bars(spark, pdf.sample(frac=1, random_state=4))
    seqd = Q.sequence(bars, ["ticker"], ["date"], partitions=13)
    want = bars.withColumn("rn", F.row_number().over(Window.partitionBy("ticker").orderBy("date")) - 1)
    got = seqd.rows.join(want.select("ticker", "date", "rn"), ["ticker", "date"])
    assert got.where(F.col("rn") != F.col(Q.SEQ)).count() == 0 and got.count() == 397
    totals = {r["ticker"]: r[Q.COUNT] for r in seqd.totals.collect()}
    assert totals == {"A": 300, "B": 7, "C": 90}


def test_frame_mixes_hot_and_ordinary_keys(spark):
    pdf = pd.concat([seasonal_bars(500, "HOT", seed=1), seasonal_bars(40, "COLD", seed=2)])
    rows = Q.frame(to_bars(spark, pdf), ["ticker"], ["date"], back=3, chunk_rows=100)
    owned = rows.where(F.col(Q.CORE)).groupBy("ticker").agg(F.countDistinct(Q.CHUNK).alias("n"))
    chunks = {r["ticker"]: r["n"] for r in owned.collect()}
    assert chunks == {"HOT": 5, "COLD": 1}
    assert rows.where(F.col(Q.CORE)).count() == 540  # halo copies are extra, owned rows are all there


def test_prefix_sum_across_chunks(spark):
    pdf = seasonal_bars(250, "A")
    pdf["w"] = range(250)
    df = spark.createDataFrame(pdf)
    rows = Q.frame(df, ["ticker"], ["date"], chunk_rows=16)
    out = Q.core_only(Q.prefix_sum(rows, ["ticker"], F.col("w"), "cum", ["date"])).toPandas().sort_values("date")
    assert out["cum"].tolist() == pd.Series(range(250)).cumsum().tolist()


def test_global_order_without_keys(spark, monkeypatch):
    monkeypatch.setattr(Q, "DEFAULT_CHUNK_ROWS", 10)
    df = spark.createDataFrame([(float(i % 37),) for i in range(200)], "s double").distinct()
    rows = Q.frame(df, [], ["s"])
    out = Q.core_only(Q.prefix_sum(rows, [], F.lit(1), "n", ["s"])).toPandas().sort_values("s")
    assert out["n"].tolist() == list(range(1, 38))


def test_chunk_size_from_session_conf(spark):
    pdf = seasonal_bars(300, "A")
    spark.conf.set(Q.CHUNK_ROWS_CONF, "64")
    try:
        rows = Q.frame(to_bars(spark, pdf), ["ticker"], ["date"], back=2)
        assert rows.where(F.col(Q.CORE)).select(Q.CHUNK).distinct().count() == 5
    finally:
        spark.conf.unset(Q.CHUNK_ROWS_CONF)
    rows = Q.frame(to_bars(spark, pdf), ["ticker"], ["date"], back=2)
    assert rows.select(Q.CHUNK).distinct().count() == 1


def test_window_tasks_are_sized_by_rows_not_by_the_session(spark, monkeypatch):
    pdf = pd.concat([seasonal_bars(n, t, seed=i) for i, (t, n) in enumerate([("A", 700), ("B", 30), ("C", 270)])])
    bars = to_bars(spark, pdf)
    assert Q.task_partitions(spark, Q.TASK_ROWS) is None
    monkeypatch.setattr(Q, "TASK_ROWS", 50)
    assert Q.task_partitions(spark, 1000) == 20 > Q.shuffle_partitions(spark)
    for size in (10, 300, 1000):  # every ticker hot, some, none
        rows = Q.frame(bars, ["ticker"], ["date"], back=2, chunk_rows=size)
        out = rows.withColumn("n", F.row_number().over(Q.chunk_window(["ticker"], ["date"])))
        assert out.rdd.getNumPartitions() >= 20
        plan = out._jdf.queryExecution().sparkPlan().toString()
        final = out._jdf.queryExecution().executedPlan().toString().split("Window", 1)[1]
        assert plan.count("REPARTITION_BY_NUM") >= 1 and "ENSURE_REQUIREMENTS" not in final.split("REPARTITION_BY_NUM")[0]
        assert out.where(F.col(Q.CORE)).count() == 1000


def test_no_task_sizing_without_keys_in_one_chunk(spark, monkeypatch):
    monkeypatch.setattr(Q, "TASK_ROWS", 10)
    df = spark.createDataFrame([(float(i),) for i in range(40)], "s double")
    rows = Q.frame(df, [], ["s"])
    assert [r["n"] for r in rows.select(F.row_number().over(Q.chunk_window([], ["s"])).alias("n")).collect()] == list(range(1, 41))


def test_run_offsets_are_broadcast_by_their_real_size(spark, monkeypatch):
    """Short keys take less than the 64 bytes that an unmeasured string counts as."""
    bars = to_bars(spark, pd.concat([seasonal_bars(3, f"{i}", seed=i) for i in range(40)]))
    monkeypatch.setattr(Q, "BROADCAST_BYTES", 4500)  # 43 runs at most: 60 bytes each, where 96 would be too many
    plan = Q.sequence(bars, ["ticker"], ["date"], partitions=4).rows._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" in plan
    monkeypatch.setattr(Q, "BROADCAST_BYTES", 1500)
    plan = Q.sequence(bars, ["ticker"], ["date"], partitions=4).rows._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in plan
