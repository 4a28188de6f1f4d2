"""Plan regression checks: the physical shape we want at scale, not only the right answer."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def count(plan: str, pattern: str) -> int:
    return len(re.findall(pattern, plan))


@pytest.mark.parametrize("name", ["features_v1", "returns", "rsi", "forward_labels", "sliding_windows"])
def test_window_queries_shuffle_once_and_stay_in_the_jvm(spark, name):
    plan = final_plan(E.queries()[name](spark, SF))
    assert count(plan, r"Exchange hashpartitioning") == 1, plan
    assert count(plan, r"InPandas|BatchEvalPython|ArrowEvalPython") == 0
    assert "ReadSchema: struct<ticker:string,date:timestamp_ntz" in plan  # column-pruned scan


def test_ema_reuses_the_window_partitioning(spark):
    plan = final_plan(E.queries()["features_v2"](spark, SF))
    assert count(plan, r"Exchange hashpartitioning") == 1
    assert count(plan, r"FlatMapGroupsInPandas") == 1


def test_tail_limits_before_the_shuffle(spark):
    plan = final_plan(E.queries()["tail_n"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ticker_scan_prunes_partitions(spark):
    plan = final_plan(E.queries()["load_ticker"](spark, SF))
    assert re.search(r"PartitionFilters: \[.*ticker.*= click", plan)
