"""Jobs, shuffle stages and source scans of one full run, from Spark's event log.

    python tools/run_stats.py [sf_dir] [adapter]

Counts, for ``plans.medallion.run``: SQL executions, jobs, stages that write
shuffle data, and how many times each source table is scanned (FileScan nodes
of the executed plans, one per scan of a table).
"""

from __future__ import annotations

import collections
import glob
import json
import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    adapter = argv[2] if len(argv) > 2 else "lineitem"
    log_dir = tempfile.mkdtemp(prefix="tickfold-eventlog-")
    from tickfold.plans import medallion
    from tickfold.session import build_session, scratch_path
    from tickfold.sources import adapters
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    inp = adapters.inputs(spark, sf_dir, adapter)
    medallion.run(spark, inp, scratch_path(spark, "stats-run"))
    spark.stop()
    jobs, shuffle_stages, sql, scans = 0, set(), 0, collections.Counter()
    files = [f for f in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(f)]
    for f in files:
        for line in open(f):
            ev = json.loads(line)
            kind = ev["Event"]
            if kind == "SparkListenerJobStart":
                jobs += 1
            elif kind == "SparkListenerTaskEnd":
                w = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                if w.get("Shuffle Records Written", 0):
                    shuffle_stages.add(ev["Stage ID"])
            elif kind.endswith("SparkListenerSQLExecutionStart"):
                sql += 1
    # scans: one per file-scan node in the final plan of each SQL execution
    final_plans = {}
    for f in files:
        for line in open(f):
            ev = json.loads(line)
            if ev["Event"].endswith(("SQLExecutionStart", "SQLAdaptiveExecutionUpdate")):
                final_plans[ev["executionId"]] = ev["physicalPlanDescription"]
    for plan in final_plans.values():
        for path in re.findall(r"Location: InMemoryFileIndex[^\[]*\[([^\]]+)\]", plan):
            scans[os.path.basename(path.rstrip("/"))] += 1
    print(json.dumps({"adapter": adapter, "sf_dir": sf_dir, "sql_executions": sql, "jobs": jobs,
                      "shuffle_map_stages": len(shuffle_stages), "source_scans": dict(scans)}))


if __name__ == "__main__":
    main(sys.argv)
