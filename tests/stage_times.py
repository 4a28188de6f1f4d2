"""Summarise a Spark event log: stages, tasks, executor run time and shuffle bytes per stage.

Usage: python tests/stage_times.py <event log dir or file>   (bench: BENCH_EVENT_LOG_DIR=...)
"""

from __future__ import annotations

import glob
import json
import os
import sys


def events(path: str):
    files = [path] if os.path.isfile(path) else sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True))
    for f in files:
        if os.path.isdir(f):
            continue
        with open(f, errors="replace") as fh:
            for line in fh:
                try:
                    yield json.loads(line)
                except ValueError:
                    continue


def main() -> None:
    stages: dict[tuple, dict] = {}
    for e in events(sys.argv[1]):
        if e.get("Event") == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            key = (e["Stage ID"], e["Stage Attempt ID"])
            s = stages.setdefault(key, {"tasks": 0, "run_ms": 0, "shuffle_write": 0, "shuffle_read": 0})
            m = e["Task Metrics"]
            s["tasks"] += 1
            s["run_ms"] += m.get("Executor Run Time", 0)
            s["shuffle_write"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            r = m.get("Shuffle Read Metrics", {})
            s["shuffle_read"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
    print("stage  tasks  run_ms  shuffle_write  shuffle_read")
    for (sid, att), s in sorted(stages.items()):
        print(f"{sid:5d}  {s['tasks']:5d}  {s['run_ms']:6d}  {s['shuffle_write']:13d}  {s['shuffle_read']:12d}")
    print("total run_ms", sum(s["run_ms"] for s in stages.values()), "stages", len(stages))


if __name__ == "__main__":
    main()
