"""Task balance of the rolling scan: plain per-symbol window vs chunked scan.

Runs both strategies over 1-minute feature windows of ``events`` (five
symbols, so every symbol holds about a fifth of the rows) and reads Spark's
event log (written to a fresh scratch folder) for the records each task
reads from the shuffle in the final stage of each job.

Usage: python tools/skew_report.py [sf_dir] [cpus]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(sf_dir: str = "/root/testdata/sf0.1", cpus: str = "8") -> None:
    from tickwise.operators.rolling import rolling_stats
    from tickwise.session import get_session, materialize
    from tickwise.sources import tables as T

    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 4, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    w = materialize(T.windows_from_events(spark, sf_dir, "1 minute"))
    n = w.count()
    sc = spark.sparkContext
    for strategy in ("direct", "chunked"):
        sc.setJobDescription(f"rolling-{strategy}")
        rolling_stats(w, strategy=strategy).write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()

    jobs, stage_tasks = {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (e.get("Properties") or {}).get("spark.job.description", "")
                    if desc.startswith("rolling-"):
                        jobs.setdefault(desc, []).extend(e["Stage IDs"])
                elif kind == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    stage_tasks.setdefault(e["Stage ID"], []).append(rec)
    print(f"window rows: {n}")
    for desc, stages in sorted(jobs.items()):
        # the widest stage that read a shuffle is the one holding the window operator
        best = max((s for s in stages if sum(stage_tasks.get(s, [])) > 0),
                   key=lambda s: sum(stage_tasks[s]), default=None)
        if best is None:
            continue
        recs = [r for r in stage_tasks[best]]
        busy = [r for r in recs if r > 0]
        print(f"{desc}: stage {best}, tasks {len(recs)}, tasks with rows {len(busy)}, "
              f"max records/task {max(recs)}, median of busy {statistics.median(busy):.0f}, "
              f"max share {max(recs) / max(sum(recs), 1):.1%}")


if __name__ == "__main__":
    main(*sys.argv[1:])
