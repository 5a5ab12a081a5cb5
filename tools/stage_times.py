"""Stage times and shuffle volumes of registered queries, from Spark's event log.

Usage: python tools/stage_times.py SF_DIR QUERY [QUERY ...]

Each run writes its event log to a fresh scratch folder (mktemp) and prints,
per query, the wall time, the number of jobs/stages/tasks, the summed task
time, and the shuffle bytes written and read - the quantities that decide
how a plan behaves on a cluster.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from panelcast.plans import catalog  # noqa: E402
from panelcast.session import SESSION_DEFAULTS, ensure_checkpoint_dir  # noqa: E402


def _session(log_dir: str) -> SparkSession:
    b = SparkSession.builder.master("local[8]").appName("panelcast-stages")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    b = (
        b.config("spark.sql.shuffle.partitions", "16")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.driver.memory", "16g")
    )
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    return s


def _summarise(events: list[dict], groups: dict[int, str]) -> dict[str, dict]:
    out: dict[str, dict] = {}
    stage_job = {}
    for e in events:
        if e.get("Event") == "SparkListenerJobStart":
            g = groups.get(int(e.get("Properties", {}).get("spark.jobGroup.id", "-1") or -1))
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = g
            if g:
                out.setdefault(g, {"jobs": 0, "stages": 0, "tasks": 0, "task_s": 0.0, "shuffle_write_mb": 0.0, "shuffle_read_mb": 0.0})
                out[g]["jobs"] += 1
        elif e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            g = stage_job.get(info["Stage ID"])
            if not g:
                continue
            r = out[g]
            r["stages"] += 1
            r["tasks"] += info.get("Number of Tasks", 0)
            for acc in info.get("Accumulables", []):
                name, val = acc.get("Name"), acc.get("Value")
                try:
                    val = float(val)
                except (TypeError, ValueError):
                    continue
                if name == "internal.metrics.executorRunTime":
                    r["task_s"] += val / 1000.0
                elif name == "internal.metrics.shuffle.write.bytesWritten":
                    r["shuffle_write_mb"] += val / 1e6
                elif name in ("internal.metrics.shuffle.read.remoteBytesRead", "internal.metrics.shuffle.read.localBytesRead"):
                    r["shuffle_read_mb"] += val / 1e6
    return out


def main() -> None:
    sf_dir = sys.argv[1]
    names = sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = _session(log_dir)
    groups: dict[int, str] = {}
    wall: dict[str, float] = {}
    for i, name in enumerate(names):
        groups[i] = name
        spark.sparkContext.setJobGroup(str(i), name)
        t0 = time.perf_counter()
        catalog.REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        wall[name] = time.perf_counter() - t0
    spark.stop()
    events = []
    for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(f):
            continue
        with open(f) as fh:
            events += [json.loads(line) for line in fh if line.strip()]
    summary = _summarise(events, groups)
    print(f"| query | wall s | jobs | stages | tasks | task s | shuffle write MB | shuffle read MB |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name in names:
        r = summary.get(name, {})
        print(
            f"| {name} | {wall[name]:.1f} | {r.get('jobs', 0)} | {r.get('stages', 0)} | {r.get('tasks', 0)} | "
            f"{r.get('task_s', 0):.1f} | {r.get('shuffle_write_mb', 0):.1f} | {r.get('shuffle_read_mb', 0):.1f} |"
        )
    print(f"\nevent log: {log_dir}")


if __name__ == "__main__":
    main()
