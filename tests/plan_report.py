"""Summarise the final (AQE) physical plan of every registered query: shuffles, joins, windows,
Python steps.  Usage: python tests/plan_report.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KINDS = [
    ("shuffle", r"Exchange (hash|range|round|single)"),
    ("reused", r"ReusedExchange"),
    ("broadcast", r"BroadcastExchange"),
    ("smj", r"SortMergeJoin"),
    ("bhj", r"BroadcastHashJoin"),
    ("window", r"\bWindow \["),
    ("group_limit", r"WindowGroupLimit"),
    ("python", r"InPandas|InArrow"),
    ("hash_agg", r"HashAggregate"),
    ("sort_agg", r"SortAggregate"),
    ("scan", r"FileScan|Scan parquet|Scan ExistingRDD"),
]


MODEL_JOBS = {f"{n}{m}" for n in ("baseline_run", "engineered_run") for m in ("", "_metrics")}
MODEL_JOBS |= {"gbt_metrics", "gbt_metric_values", "batch_predictions", "batch_prediction_scores", "champion_scoring", "champion_scores"}


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def main() -> None:
    from barspark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    import __spark_entry__ as E

    print(f"# Final physical plans ({sf}, AQE on, 8 shuffle partitions)\n")
    print("Counts of operators in the final adaptive plan of each registered query (side jobs such as")
    print("staging the derived bars or the hot-key count are separate, not shown).  The model jobs, which return")
    print("a few rows of what they fitted, are left out.\n")
    print("| query | " + " | ".join(k for k, _ in KINDS) + " |")
    print("|---|" + "---|" * len(KINDS))
    for name, fn in E.queries().items():
        if name in MODEL_JOBS:
            continue
        try:
            plan = final_plan(fn(spark, sf))
            counts = [len(re.findall(rx, plan)) for _, rx in KINDS]
            print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |", flush=True)
        except Exception as exc:  # noqa: BLE001
            print(f"| {name} | error: {type(exc).__name__} |", flush=True)


if __name__ == "__main__":
    main()
