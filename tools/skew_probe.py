"""Skew probe: one vehicle holding every reading, per-vehicle window vs chunked.

Maps all of ``lineitem`` to a single vehicle (daily windows, every day of
seven years holds all seven signals), runs the ML chain both ways, and reads
Spark's event log (written to a scratch folder) to report, per stage, how many
shuffle records the busiest task read against the stage total. With a
per-vehicle window one task reads the whole series; with chunks the main pass
is spread over the shuffle partitions and only the chunk edges (12 rows per
chunk) meet in one task per vehicle. Chunks must hold many more rows than
those 12 for this to pay off; ``chunk="auto"`` sizes them at 8,640 windows.

Usage: python tools/skew_probe.py [sf_dir]
"""
from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from voltaic.operators.features import ml_dataset
    from voltaic.sources.readings import lineitem_as_readings

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="skew-probe-")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    hot = lineitem_as_readings(spark, sf_dir).withColumn("vehicle_id", F.lit("HOT"))
    groups = {}
    for label, chunk in (("per_vehicle", None), ("chunked_300_days", "300 days")):
        spark.sparkContext.setJobGroup(label, label)
        n = ml_dataset(hot, window="1 day", band=(1.0, 50.0), threshold=20.0, chunk=chunk).count()
        groups[label] = n
    spark.stop()

    jobs, stage_job, tasks = {}, {}, {}
    for path in [p for p in glob.glob(os.path.join(logs, "**", "*"), recursive=True) if os.path.isfile(p)]:
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                props = ev.get("Properties") or {}
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = props.get("spark.jobGroup.id")
            elif kind == "SparkListenerTaskEnd":
                m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                tasks.setdefault(ev["Stage ID"], []).append(m.get("Total Records Read", 0))
    for sid, recs in sorted(tasks.items()):
        label = stage_job.get(sid)
        if label and sum(recs) > 0:
            jobs.setdefault(label, []).append((sid, max(recs), sum(recs), len(recs)))
    out = {}
    for label, stages in jobs.items():
        worst = max(stages, key=lambda s: s[1])
        out[label] = {"rows": groups[label], "busiest_task_records": worst[1], "stage_records": worst[2],
                      "busiest_share": round(worst[1] / worst[2], 3),
                      "stages": [{"stage": s[0], "max_task": s[1], "total": s[2], "tasks": s[3]} for s in stages]}
    print(json.dumps(out, indent=1))


if __name__ == "__main__":
    main()
