"""Bytes of task results sent to the driver, per query, from Spark's event log.

Usage: python tests/driver_bytes.py SF_DIR name [name ...]  -> one JSON line
Each query's full result is written to the ``noop`` sink under its own job
group; automatic broadcasts are off so only explicitly bounded tables are
broadcast (their build side passes through the driver).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    logdir = tempfile.mkdtemp(prefix="txnlab-eventlog-")
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[4]").appName("driver-bytes")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from __spark_entry__ import queries

    qs = queries()
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group: dict[int, str] = {}
    sizes: dict[str, int] = {n: 0 for n in names}
    tasks: dict[str, int] = {n: 0 for n in names}
    files = [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in sorted(files):
        if path.endswith((".zstd", ".lz4", ".snappy", ".gz")):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    if g in sizes:
                        sizes[g] += int((ev.get("Task Metrics") or {}).get("Result Size", 0))
                        tasks[g] += 1
    print(json.dumps({n: {"bytes": sizes[n], "tasks": tasks[n],
                          "bytes_per_task": round(sizes[n] / max(1, tasks[n]))} for n in names}))


if __name__ == "__main__":
    main()
